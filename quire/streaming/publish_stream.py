"""Appending a stream to a dataset: each micro-batch is one commit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quire.context import Context
from quire.functions import checks
from quire.operators.publish import commit, prepare

STREAM_NAMESPACE = uuid.UUID("0b8f4c1e-9a7d-4e2b-8c3f-5d6e7f809a1b")


def batch_commit_id(checkpoint: str, batch_id: int) -> str:
    """Same checkpoint and batch id -> same commit id, so a replayed batch
    (after a driver or executor failure) finds its entry and writes nothing."""
    return str(uuid.uuid5(STREAM_NAMESPACE, f"{checkpoint.rstrip('/')}#{int(batch_id)}"))


def publish_stream(
    ctx: Context,
    sdf: DataFrame,
    dataset_id,
    checkpoint: str,
    name: str,
    description: str = "",
    tags=None,
    partition_by=None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Start a streaming query that appends every micro-batch of ``sdf`` to
    ``dataset_id`` (created by the first batch). ``checkpoint`` must be a shared
    folder. ``trigger`` defaults to ``{"availableNow": True}``."""
    if not sdf.isStreaming:
        raise TypeError("sdf must be a streaming DataFrame")
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    checks.check_name(name)
    checks.check_description(description)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        plan = prepare(
            ctx, batch, name, description, tags=tags, dataset_id=ds, mode="append",
            partition_by=partition_by, inputs=[], commit_id=batch_commit_id(checkpoint, batch_id),
            create=True, options=options,
        )
        if isinstance(plan, dict):
            out = plan
        else:
            plan.skip_empty = True  # known from the write itself: the source is read once
            out = commit(ctx, plan)
        if not out.get("accepted"):
            # fail the batch so Spark retries it with the same batch id
            raise RuntimeError(f"micro-batch {batch_id} not committed: {out.get('error')}")

    w = sdf.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()
