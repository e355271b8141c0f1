"""A published dataset as the source of a stream: each commit's changes, once and in order.

The stream follows the dataset's log, whose entries are numbered files, with Spark's own file source, so
what has been delivered is in the query's checkpoint. A micro-batch takes the versions up to the highest one that
it saw, from the one where the batch before it ended, and asks for the changes between the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.context import Context
from quire.errors import DatasetNotFoundError
from quire.functions import checks
from quire.sources import filesystem as fsys
from quire.sources.catalogue_log import LOG_SCHEMA, dataset_log, last_version
from quire.sources.changes import read_changes

_SAME_ROWS = ("compact", "alter", "fence", "expire")  # commits that change no row


def _ended(ctx: Context, checkpoint: str, batch_id: int) -> str:
    return f"{checkpoint.rstrip('/')}/versions/{batch_id:012d}"


def stream_changes(
    ctx: Context, dataset_id, checkpoint: str, on_changes: Callable[[DataFrame, int, int, int], None], start_version: int = 0,
    versions_per_batch: int | None = None, trigger: dict | None = None, change_column: str = "_change",
) -> StreamingQuery:
    """Start a query that calls ``on_changes(changes, from_version, to_version, batch_id)`` for the commits after
    ``start_version``: rows added and removed, as :func:`read_changes` gives them, in the columns of ``to_version``.

    Batches follow one another without gap or overlap, also over a restart from the same ``checkpoint`` (a shared folder).
    A batch that failed is called again with the same versions and id, so a sink that takes each id once, as
    ``publish(..., commit_id=...)`` does, has every change once. Compactions and other commits that
    change no row give no call of their own. A version that has expired before it was delivered ends the query with
    ``VersionExpiredError``. ``trigger`` defaults to ``{"availableNow": True}``.
    """
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    if not callable(on_changes):
        raise TypeError("on_changes must be callable")
    if not isinstance(start_version, int) or isinstance(start_version, bool) or start_version < 0:
        raise ValueError("start_version must be an int, 0 or more")
    if not last_version(ctx, ds):
        raise DatasetNotFoundError(f"no dataset {ds}")
    spark = ctx.spark

    def on_batch(entries: DataFrame, batch_id: int) -> None:
        before = fsys.read_bytes_if(spark, _ended(ctx, checkpoint, batch_id - 1)) if batch_id else None
        low = int(before) if before else start_version
        # entries may come out of order: a version below the last batch's end is in that batch
        high = max(low, entries.agg(F.max("version")).first()[0] or 0)
        if high > low:
            changes = read_changes(ctx, ds, low, high, change_column)
            log = dataset_log(ctx, ds).filter(F.col("version").between(low + 1, high) & ~F.col("mode").isin(*_SAME_ROWS))
            if not log.isEmpty():
                on_changes(changes, low, high, batch_id)
        fsys.put_bytes(spark, _ended(ctx, checkpoint, batch_id), str(high).encode())

    reader = spark.readStream.schema(LOG_SCHEMA)
    if versions_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", versions_per_batch)
    writer = reader.parquet(ctx.log_of(ds)).writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
