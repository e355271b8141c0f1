"""Catalogue tables as DataFrames, and queries over them.

``datasets``  (dataset_id, name, description, schema_id, folder, format,
               partition_by, tags, created_at)
``commits``   (dataset_id, version, commit_id, mode, schema_id, n_rows, committed_at)
``schemas``   (schema_id, ordinal, column_name, data_type, nullable)
``lineage``   (dataset_id, commit_id, input_dataset_id)
``tags``      (dataset_id, name, tag_key, tag_value)
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from quire.context import Context
from quire.plans import visibility
from quire.sources.catalogue_log import dataset_log, latest_log, read_log, schema_table

ATTRS = ["mode", "name", "description", "schema_id", "folder", "format", "partition_by", "tags", "created_at"]


def commits(ctx: Context) -> DataFrame:
    return read_log(ctx).select("dataset_id", "version", "commit_id", "mode", "schema_id", "n_rows", "committed_at")


def history(ctx: Context, dataset_id: str | None = None) -> DataFrame:
    """Commits with their ``version`` and whether they are live now."""
    log = read_log(ctx) if dataset_id is None else dataset_log(ctx, dataset_id)
    return visibility.with_live(log).select(
        "dataset_id", "commit_id", "mode", "schema_id", "n_rows", "total_rows", "committed_at", "version", "live"
    )


def datasets(ctx: Context) -> DataFrame:
    """Datasets whose last commit is not a deletion, with the attributes of that commit."""
    last = visibility.latest(latest_log(ctx), ATTRS)
    return last.filter(F.col("mode") != "delete").select(
        "dataset_id", "name", "description", "schema_id", "folder", "format", "partition_by", "tags", "created_at"
    )


def schemas(ctx: Context) -> DataFrame:
    return schema_table(ctx).select("schema_id", F.explode("columns").alias("c")).select("schema_id", "c.*")


def lineage(ctx: Context) -> DataFrame:
    """Inputs of the live commits."""
    live = visibility.with_live(read_log(ctx)).filter("live")
    return live.select("dataset_id", "commit_id", F.explode("inputs").alias("input_dataset_id")).distinct()


def tags(ctx: Context) -> DataFrame:
    return (
        datasets(ctx)
        .select("dataset_id", "name", F.explode("tags").alias("tag_key", "_values"))
        .select("dataset_id", "name", "tag_key", F.explode("_values").alias("tag_value"))
    )


def catalogue_datasets(ctx: Context) -> DataFrame:
    """Datasets with row counts from their last commit, which carries the total: one scan of
    the last entries and one partial aggregate."""
    last = visibility.latest(latest_log(ctx), [*ATTRS, "total_rows", "n_live", "committed_at"])
    return last.filter(F.col("mode") != "delete").select(
        "dataset_id", F.col("name").alias("dataset_name"), "description", F.col("total_rows").alias("n_rows"),
        F.col("n_live").alias("n_live_commits"), "created_at", F.col("committed_at").alias("last_commit_at"),
    )


def _tag_match(key: str, values) -> F.Column:
    if isinstance(values, str):
        values = [values]
    vals = F.element_at(F.col("tags"), F.lit(key))
    cond = F.lit(False)
    for v in values:
        cond = cond | F.coalesce(F.array_contains(vals, F.lit(str(v))), F.lit(False))
    return F.coalesce(F.map_contains_key(F.col("tags"), F.lit(key)), F.lit(False)) & cond


def _like_escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def search(
    ctx: Context,
    tags: Mapping | None = None,
    text: str | None = None,
    without: Mapping | None = None,
) -> DataFrame:
    """Datasets carrying every tag in ``tags`` (a value or any of a list of
    values), none of the tags in ``without``, and ``text`` in their name or
    description (case-insensitive). A missing map or key counts as not
    carrying the tag (T16)."""
    df = datasets(ctx)
    cond = F.lit(True)
    for k, v in (tags or {}).items():
        cond = cond & _tag_match(str(k), v)
    for k, v in (without or {}).items():
        cond = cond & ~_tag_match(str(k), v)
    if text:
        pat = f"%{_like_escape(text)}%"
        cond = cond & (
            F.coalesce(F.col("name").ilike(pat), F.lit(False))
            | F.coalesce(F.col("description").ilike(pat), F.lit(False))
        )
    return df.filter(cond)
