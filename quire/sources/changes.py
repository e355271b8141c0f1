"""What changed between two versions of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire.context import Context
from quire.errors import DatasetNotFoundError
from quire.functions import checks
from quire.sources.catalogue_log import dataset_log
from quire.sources.datasets import DatasetState, Rows, _unused, dataset_state


def _as_target(df: DataFrame, st: DatasetState, target: DatasetState) -> DataFrame:
    """Rows of one version with another's columns, matched by column id; columns that are not there are null."""
    name_of = {i: n for n, i in st.fields.ids.items()}
    ids = target.fields.ids
    columns = []
    for f in target.schema.fields:
        name = name_of.get(ids[f.name])
        value = F.col(f"`{name}`").cast(f.dataType) if name is not None else F.lit(None).cast(f.dataType)
        columns.append(value.alias(f.name))
    return df.select(*columns)


def _step(ctx: Context, old: DatasetState | None, new: DatasetState) -> tuple[list, list]:
    """(rows of ``new``, rows of ``old``) between two versions without a compaction between them, from
    their commits: what both have is not read unless a commit between hides rows of it."""
    before = {c.data_folder: c for c in (old.live if old is not None and old.exists else [])}
    after = {c.data_folder: c for c in (new.live if new.exists else [])}
    hides_now = [c for c in after.values() if c.hides]
    hid_before = [c for c in before.values() if c.hides]
    added, removed = [], []
    fresh = [c for f, c in after.items() if f not in before]
    if fresh:
        added.append((Rows(ctx, new, fresh, any(c.hidden for c in hides_now)).hide(hides_now).columns(), new))
    lost = [c for f, c in before.items() if f not in after]
    if lost:
        removed.append((Rows(ctx, old, lost, any(c.hidden for c in hid_before)).hide(hid_before).columns(), old))
    kept = [c for f, c in after.items() if f in before]
    hiding = [c for c in fresh if c.hides]
    if kept and hiding:
        places = any(c.hidden for c in hid_before + hiding)
        removed.append((Rows(ctx, new, kept, places).hide(hid_before).only_hidden(hiding).columns(), new))
    return added, removed


def read_changes(ctx: Context, dataset_id: str, from_version: int, to_version: int | None = None, change_column: str = "_change") -> DataFrame:
    """Rows that were added to and removed from a dataset after ``from_version`` and up to ``to_version`` (the
    last by default), with ``change_column`` saying ``added`` or ``removed``. Version 0 is before the first commit.

    As multisets, the one version less the removed rows plus the added ones is the other, and no row
    is in both. The rows come from the commits between: those of appended folders, of slices that were replaced,
    of places that a merge hid. A compaction moves rows and so changes nothing; the folders on both sides of
    it are not compared. Only where rows were also removed are added and removed ones set against
    each other, in one aggregation. Rows have the columns of ``to_version``, matched by column id, so a
    renamed or dropped column is no change of rows.
    """
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    for v in (from_version, to_version):
        if v is not None and (not isinstance(v, int) or isinstance(v, bool) or v < 0):
            raise ValueError("versions must be ints, 0 or more")
    target = dataset_state(ctx, ds, to_version)
    if target is None or target.attrs["schema_json"] is None:
        raise DatasetNotFoundError(f"no dataset {ds}")
    if from_version > target.version:
        raise ValueError(f"from_version {from_version} is after version {target.version}")
    if change_column in target.schema.fieldNames():
        raise ValueError(f"the dataset has a column {change_column!r}; name another for the kind of change")
    log = dataset_log(ctx, ds).filter(F.col("version").between(from_version + 1, target.version) & (F.col("mode") == "compact"))
    cuts = sorted(r[0] for r in log.select("version").collect())
    at = lambda v: None if v == 0 else target if v == target.version else dataset_state(ctx, ds, v)
    steps, low = [], from_version
    for cut in cuts:
        steps.append((low, cut - 1))
        low = cut
    steps.append((low, target.version))
    if from_version:
        at(from_version)  # an expired version is an error, also where nothing changed
    added, removed = [], []
    for a, b in steps:
        if a < b:
            x, y = _step(ctx, at(a), at(b))
            added += x
            removed += y

    def union(parts: list) -> DataFrame | None:
        out = None
        for df, st in parts:
            df = _as_target(df, st, target)
            out = df if out is None else out.unionByName(df)
        return out

    plus, minus = union(added), union(removed)
    if plus is None and minus is None:
        return ctx.spark.createDataFrame([], target.schema).withColumn(change_column, F.lit(None).cast("string"))
    if plus is None or minus is None:
        return (plus if minus is None else minus).withColumn(change_column, F.lit("removed" if plus is None else "added"))
    taken = {n.lower() for n in (*target.schema.fieldNames(), change_column)}
    n, each = _unused("_n", taken), _unused("_each", taken)
    names = [F.col(f"`{c}`") for c in target.schema.fieldNames()]
    both = plus.withColumn(n, F.lit(1)).unionByName(minus.withColumn(n, F.lit(-1)))
    net = both.groupBy(*names).agg(F.sum(n).alias(n)).filter(F.col(n) != 0)
    kind = F.when(F.col(n) > 0, "added").otherwise("removed")
    net = net.withColumn(change_column, kind).withColumn(each, F.explode(F.sequence(F.lit(1).cast("long"), F.abs(F.col(n)))))
    return net.select(*names, change_column)
