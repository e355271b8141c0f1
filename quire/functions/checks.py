"""Argument checks of the publish surface (raised, never reported)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from quire import messages as msg

MODES = ("overwrite", "append", "error", "ignore")
PRIMITIVES = (str, int, float, bool)
RESERVED = "commit_id"


def check_frame(df) -> None:
    if not isinstance(df, DataFrame):
        raise TypeError(msg.NOT_A_FRAME)
    if df.isStreaming:
        raise TypeError("df is a streaming DataFrame; use publish_stream")


def check_name(name) -> None:
    if not isinstance(name, str) or not name:
        raise TypeError(msg.BAD_NAME)


def check_description(description) -> None:
    if not isinstance(description, str):
        raise TypeError(msg.BAD_DESCRIPTION)


def check_tags(tags) -> None:
    if tags is not None and not isinstance(tags, Mapping):
        raise TypeError(msg.BAD_TAGS)


def check_mode(mode) -> None:
    if mode not in MODES:
        raise ValueError(msg.BAD_MODE.format(mode=mode))


def check_dataset_id(dataset_id) -> str | None:
    """A dataset id is a UUID (object or canonical string)."""
    if dataset_id is None:
        return None
    if isinstance(dataset_id, uuid.UUID):
        return str(dataset_id)
    if isinstance(dataset_id, str):
        try:
            return str(uuid.UUID(dataset_id))
        except ValueError:
            pass
    raise TypeError("dataset_id must be a UUID")


_COMMIT_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}")


def check_commit_id(commit_id) -> str | None:
    """A commit id names a folder: letters, digits, ``.``, ``_``, ``-``, not
    starting with a hidden-name character."""
    if commit_id is None:
        return None
    if not isinstance(commit_id, str) or not _COMMIT_ID.fullmatch(commit_id):
        raise TypeError("commit_id must be 1-128 of [A-Za-z0-9._-], starting with a letter or digit")
    return commit_id


def partition_list(partition_by) -> list[str]:
    if partition_by is None:
        return []
    if isinstance(partition_by, str):
        return [partition_by]
    if isinstance(partition_by, (list, tuple)) and all(isinstance(c, str) for c in partition_by):
        return list(partition_by)
    raise TypeError("partition_by must be a string, a list of strings or None")


def check_columns(df: DataFrame, partition_by: list[str]) -> None:
    names = df.columns
    if not names:
        raise ValueError("a frame without columns cannot be published")
    lower = [n.lower() for n in names]
    dupes = sorted({n for n in lower if lower.count(n) > 1})
    if dupes:
        raise ValueError(f"column names equal up to case: {dupes}")
    if RESERVED in lower:
        raise ValueError(f"column name '{RESERVED}' is reserved for commit folders")
    missing = [c for c in partition_by if c not in names]
    if missing:
        raise ValueError(f"unknown partition columns: {missing}")
    if partition_by and len(set(partition_by)) == len(names):
        raise ValueError("cannot partition by all columns")


def clean_options(options: Mapping) -> dict[str, str]:
    """Writer/reader options with ``None`` dropped (T12)."""
    out = {}
    for k, v in options.items():
        if v is None:
            continue
        if not isinstance(v, PRIMITIVES):
            raise TypeError(f"option {k} must be str, int, float or bool")
        out[k] = str(v).lower() if isinstance(v, bool) else str(v)
    return out


def normalise_tags(tags) -> dict[str, list[str]]:
    """Tag values become lists of strings; scalars one-element lists (T15)."""
    out: dict[str, list[str]] = {}
    for k, v in (tags or {}).items():
        if v is None:
            vals: list[str] = []
        elif isinstance(v, (list, tuple, set, frozenset)):
            vals = [str(x) for x in v]
        else:
            vals = [str(v)]
        out[str(k)] = vals
    return out
