"""Merging rows into a dataset by key.

Nothing old is rewritten. The frame's rows are a new commit; the old rows with the same keys are hidden by their
places, the file and the row's number in it, in a small table that belongs to the commit. Readers
leave these rows out by one anti-join, and only while files that hold such rows are live: a compaction or an
overwrite ends it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from quire.context import Context
from quire.errors import SchemaMismatchError
from quire.functions import checks
from quire.operators.publish import (
    CommitPlan, _folder_name, _refusal, commit, failure, fit_append, guard_partition_values, hide_places, inputs_of, prior_outcome,
    referenced, written_rows,
)
from quire.sources.datasets import _unused, dataset_state, visible


def _typed(df: DataFrame, on: list[str], types: dict) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in on])


def merge_rows(ctx: Context, df: DataFrame, dataset_id, on, delete_where: str | None = None, commit_id=None, **options) -> dict:
    """Update, insert and delete rows of a dataset, matched by the columns ``on``.

    Afterwards the dataset has, for each key of ``df``, exactly the frame's row, or none where the SQL predicate
    ``delete_where`` holds; rows with other keys stay as they are. The predicate may use columns that the dataset does
    not have, which are then left out. The frame must have all columns of the dataset.

    Two rows of ``df`` with one key are refused, and nothing is changed. A null in a key matches nothing: such a row is
    inserted, and one to be deleted does nothing. The frame is read more than once, so it must be deterministic.
    Where another commit comes between, the rows to hide are looked for again in what is live then.
    """
    checks.check_frame(df)
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    keys = [on] if isinstance(on, str) else list(on or [])
    if not keys or not all(isinstance(k, str) and k for k in keys) or len(set(keys)) != len(keys):
        raise TypeError("on must be one or more distinct column names")
    if delete_where is not None and (not isinstance(delete_where, str) or not delete_where.strip()):
        raise TypeError("delete_where must be a SQL predicate or None")
    cid = checks.check_commit_id(commit_id)
    opts = checks.clean_options(options)
    checks.check_columns(df, [])
    if not df._jdf.queryExecution().analyzed().deterministic():
        raise ValueError("the frame to merge must give the same rows each time it is read; publish it first")
    if cid is not None and (prior := prior_outcome(ctx, ds, cid, "merge")):
        return prior
    cid = cid or str(uuid.uuid4())
    state = dataset_state(ctx, ds)
    if refused := _refusal("merge", ds, cid, state, False):
        return refused
    if (state.format or ctx.format) != "parquet":
        raise ValueError("only Parquet files number their rows")
    types = {f.name: f.dataType for f in state.schema.fields}
    if unknown := [k for k in keys if k not in types or k not in df.columns]:
        raise ValueError(f"key columns missing: {unknown}")
    keep, gone = df, None
    if delete_where is not None:
        named = set(referenced(df, delete_where))
        hit = F.coalesce(F.expr(delete_where), F.lit(False))
        lower = {n.lower() for n in types}
        keep = df.filter(~hit).drop(*[c for c in named if c.lower() not in lower])
        gone = df.filter(hit)
    try:
        frame, schema = fit_append(keep, state.schema, False)
        if missing := [c for c in types if c not in frame.columns]:
            raise SchemaMismatchError(f"columns missing from the frame: {missing}")
    except SchemaMismatchError as e:
        return failure(e, ds, cid)
    gone = _typed(gone, keys, types) if gone is not None else None

    def merged_keys(ctx: Context, plan: CommitPlan) -> DataFrame:
        mine = written_rows(ctx, plan).select(*[F.col(f"`{k}`") for k in keys])
        return mine if gone is None else mine.unionByName(gone)

    def one_row_a_key(ctx: Context, plan: CommitPlan) -> str | None:
        known = merged_keys(ctx, plan).dropna(subset=[f"`{k}`" for k in keys])
        n = _unused("n", {k.lower() for k in keys})
        twice = known.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > 1).first()
        return f"several rows with one key, as {tuple(twice)[:-1]}" if twice else None

    def hide(ctx: Context, plan: CommitPlan) -> int:
        """Writes the places of the live rows with the frame's keys; returns how many there are."""
        old = visible(ctx, plan.state, positions=True)
        mine = merged_keys(ctx, plan)
        names = {k: _unused("_key", old.taken) for k in keys}
        mine = mine.select(*[F.col(f"`{k}`").alias(a) for k, a in names.items()])
        same: Column = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(a) for k, a in names.items()])
        places = old.df.select(*[F.col(f"`{k}`") for k in keys], old.file, old.row).join(mine, same, "left_semi")
        return hide_places(ctx, plan, places.select(F.col(old.file).alias("file"), F.col(old.row).alias("row")))

    folder = _folder_name(cid)
    return commit(ctx, CommitPlan(
        dataset_id=ds, commit_id=cid, requested="merge", mode="merge", frame=guard_partition_values(frame, state.partition_by),
        name=state.attrs["name"], description=state.attrs["description"], tags=dict(state.attrs["tags"] or {}),
        partition_by=state.partition_by, schema=schema, schema_id=state.attrs["schema_id"], fields=state.fields,
        inputs=inputs_of(ctx, df), data_folder=folder, folder=ctx.commit_dir(ds, folder), fmt="parquet", options=opts, state=state,
        hide=hide, after_write=one_row_a_key, skip_by=state.skip_by,
    ))
