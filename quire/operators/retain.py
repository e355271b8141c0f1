"""Retention: giving up old versions and the data that only they need."""

from __future__ import annotations

from datetime import datetime
from itertools import islice

from pyspark.sql import functions as F

from quire.context import Context
from quire.errors import DatasetNotFoundError
from quire.functions import checks
from quire.operators.publish import change_entry, failure, remove_attempt
from quire.sources import filesystem as fsys
from quire.sources.catalogue_log import dataset_log
from quire.sources.datasets import DatasetState, _utc, dataset_state

_BATCH = 1000  # folders that the driver holds and removes at a time


def expire_versions(ctx: Context, dataset_id, keep: int | None = None, as_of: datetime | str | None = None, dry_run: bool = False) -> dict:
    """Removes the data that no kept version reads. Kept are the last ``keep`` versions, or the version that stood
    at the instant ``as_of`` and all later ones.

    A version reads the commits from its last overwrite or compaction on, and those that a compaction carried;
    all other folders go, found by one anti-join of the dataset's log with itself. First a commit says which
    versions are given up, so that a read of one is a ``VersionExpiredError``, then the folders are removed, a bounded
    number at a time. A run that is cut short leaves folders that the next one removes. Reads of an expired version that
    are under way may fail. Returns an outcome with ``oldest`` (version), ``n_commits``, ``n_files`` and ``bytes``
    removed, or to be removed where ``dry_run``.
    """
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    if (keep is None) == (as_of is None):
        raise ValueError("give either keep or as_of")
    if keep is not None and (not isinstance(keep, int) or isinstance(keep, bool) or keep < 1):
        raise ValueError("keep must be a positive int")
    st = dataset_state(ctx, ds)
    if st is None or not st.exists:
        return failure(DatasetNotFoundError(f"no live dataset {ds}"), ds, None)
    rows = dataset_log(ctx, ds)
    before = rows.agg(F.max("expired_before")).first()[0] or 1
    if keep is not None:
        oldest = st.version - keep + 1
    else:
        us = int(_utc(as_of).timestamp() * 1_000_000)
        oldest = rows.filter(F.unix_micros("committed_at") <= us).agg(F.max("version")).first()[0] or 1
    oldest = max(oldest, before)
    first = rows.filter(F.col("version") <= oldest).agg(F.max_by("reset_version", "version")).first()[0] or 1
    out = {"dataset_id": ds, "commit_id": None, "accepted": True, "status": "planned", "oldest": oldest}
    if not dry_run and oldest > before:
        def change(st: DatasetState | None) -> dict | None:
            return {"expired_before": oldest} if st is not None and st.exists else None

        row = change_entry(ctx, ds, "expire", change)
        if row is None:
            return failure(DatasetNotFoundError(f"no live dataset {ds}"), ds, None)
        out |= {"commit_id": row["commit_id"], "version": row["version"]}
    data = rows.filter(F.col("data_folder").isNotNull())
    needed = rows.filter(F.col("version") >= first)
    needed = needed.select("data_folder").unionByName(needed.select(F.explode("carried.data_folder").alias("data_folder")))
    folders = data.select("data_folder").join(needed, "data_folder", "left_anti").toLocalIterator()

    def remove(name: str) -> tuple[int, int, int]:
        found = [x for x in (fsys.size_of(ctx.spark, d) for d in ctx.attempt_dirs(ds, name)) if x]
        if found and not dry_run:
            remove_attempt(ctx, ds, name)
        return bool(found), sum(n for n, _ in found), sum(b for _, b in found)

    total = [0, 0, 0]
    while batch := [r[0] for r in islice(folders, _BATCH)]:
        for counts in fsys.each(remove, batch):
            total = [a + b for a, b in zip(total, counts)]
    out |= dict(zip(("n_commits", "n_files", "bytes"), total))
    return out if dry_run else out | {"status": "expired"}
