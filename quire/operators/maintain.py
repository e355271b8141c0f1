"""Maintenance: sweep of unfinished attempts, dataset compaction, partition counts."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from quire.context import Context
from quire.errors import DatasetNotFoundError
from quire.functions import checks
from quire.operators.publish import CommitPlan, _folder_name, commit, fence, remove_attempt, remove_before
from quire.sources import filesystem as fsys
from quire.sources.catalogue_log import read_log, started
from quire.sources.datasets import dataset_state, read_state, visible

SWEEP_SCHEMA = (
    "folder string, dataset_id string, commit_id string, started_at timestamp, n_files bigint, bytes bigint, "
    "has_files boolean, deleted boolean"
)


def _cutoff(older_than) -> datetime:
    now = datetime.now(timezone.utc)
    if isinstance(older_than, datetime):
        return older_than if older_than.tzinfo else older_than.replace(tzinfo=timezone.utc)
    if isinstance(older_than, timedelta):
        return now - older_than
    if isinstance(older_than, (int, float)) and not isinstance(older_than, bool):
        return now - timedelta(seconds=float(older_than))
    raise TypeError("older_than must be a datetime cutoff, a timedelta or seconds")


def sweep_orphans(ctx: Context, older_than, dry_run: bool = True) -> DataFrame:
    """Folders nobody can read: of attempts that neither committed nor were undone (T2), and of
    deleted datasets whose removal failed. Columns: folder, dataset_id, commit_id, started_at,
    n_files, bytes, has_files, deleted.

    Every attempt leaves a mark before it writes and takes it away when it is done, so the sweep
    reads only marks: one anti-join with the commits, whatever the store's size. Attempts begun
    after the cutoff are left alone. One that is still at work is fenced first: the next number of its
    dataset's log says that it may not commit, so either the attempt commits before, and its data stays, or its
    publisher ends with an error. What the driver holds and does is a few calls for each crashed attempt: its files are
    listed there, and removed there.
    """
    spark = ctx.spark
    cut = int(_cutoff(older_than).timestamp() * 1_000_000)
    marks = started(ctx).filter(F.unix_micros("started_at") < cut)
    done = read_log(ctx).filter(F.col("data_folder").isNotNull()).select(
        F.concat("folder", F.lit("/Processed/commit_id="), "data_folder").alias("folder"))
    # a mark whose attempt did commit only lost its own removal
    left = marks.join(done, "folder", "left_anti").select("folder", "dataset_id", "commit_id", "started_at").collect()
    attempts: dict[str, list[str]] = {}
    for r in left:
        if r["folder"] != ctx.dataset_root(r["dataset_id"]):
            attempts.setdefault(r["dataset_id"], []).append(r["folder"].rsplit("commit_id=", 1)[1])

    def fence_all(item) -> set[str]:
        return fence(ctx, *item)

    sizes = fsys.each(lambda r: fsys.size_of(spark, r["folder"]) or (0, 0), left)
    fenced = set().union(*fsys.each(fence_all, attempts.items())) if not dry_run else set()

    def remove(r) -> bool:
        ds = r["dataset_id"]
        if r["folder"] == ctx.dataset_root(ds):
            st = dataset_state(ctx, ds)
            gone = remove_before(ctx, ds, st.version if st and not st.exists else 0)
            name = r["commit_id"]
        else:
            name = r["folder"].rsplit("commit_id=", 1)[1]
            if name not in fenced:  # committed meanwhile
                return False
            remove_attempt(ctx, ds, name)
            gone = True
        if gone:
            fsys.delete(spark, f"{ctx.started_dir}/{name}.parquet")
        return gone

    deleted = fsys.each(remove, left) if not dry_run else [False] * len(left)
    out = [(*r, *size, size[0] > 0, gone) for r, size, gone in zip(left, sizes, deleted)]
    return spark.createDataFrame(out, SWEEP_SCHEMA)


def partition_counts(ctx: Context, dataset_id: str) -> DataFrame:
    """Rows and files per stored partition of the live dataset. Partition values
    come from the file paths; counting needs no data column."""
    ds = checks.check_dataset_id(dataset_id)
    st = dataset_state(ctx, ds)
    if st is None or not st.exists:
        raise DatasetNotFoundError(f"no live dataset {ds}")
    parts = st.partition_by
    rows = visible(ctx, st, positions=True)
    keys = [F.col(f"`{p}`") for p in parts]
    per_file = rows.df.groupBy(*keys, rows.file).agg(F.count(F.lit(1)).alias(rows.row))
    return per_file.groupBy(*keys).agg(F.sum(rows.row).alias("n_rows"), F.count(F.lit(1)).alias("n_files"))


_RANKS = 256  # ranges of a column's values in a clustering key
_TARGET = 128 << 20  # bytes of a file when their number is not given


def _number(column: Column, kind: DataType) -> Column:
    """A number in the order of the column's values; of a string, its first seven bytes."""
    if isinstance(kind, StringType):
        head = F.rpad(F.hex(F.encode(F.substring(column, 1, 7), "UTF-8")), 14, "0")
        return F.conv(F.substring(head, 1, 14), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.to_timestamp_ltz(column.cast("string"))).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("double")
    return column.cast("double")


def _rank(number: Column, steps: list[float]) -> Column:
    """How many of the ascending ``steps`` (fewer than 256) are at most ``number``: a binary search for each row."""
    if not steps:
        return F.lit(0)
    rising = F.array(*[F.lit(float(x)) for x in steps])

    def further(at: Column, width: Column) -> Column:
        # past the end nothing is added; get() is null there
        return at + F.when(F.get(rising, at + width - 1) <= number, width).otherwise(F.lit(0))

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(7, -1, -1)]), F.lit(0), further)


def z_order(df: DataFrame, names: list[str]) -> Column:
    """A key that keeps rows near that are near in all of these columns: the columns' ranks among
    256 ranges of equal counts, bits interleaved. The ranges' bounds come from one aggregate; nulls come first."""
    numbers = [_number(F.col(f"`{n}`"), df.schema[n].dataType) for n in names]
    shares = [i / _RANKS for i in range(1, _RANKS)]
    bounds = df.agg(*[F.percentile_approx(c, shares, 2000).alias(f"b{i}") for i, c in enumerate(numbers)]).first()
    key = F.lit(0).cast("long")
    for j, (c, b) in enumerate(zip(numbers, bounds)):
        rank = F.when(c.isNull(), 0).otherwise(_rank(c, sorted(set(b or [])))).cast("long")
        for bit in range(8):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * len(names) + j))
    return key


def compact_dataset(ctx: Context, dataset_id: str, files: int | None = None, cluster_by=None) -> dict:
    """Rewrite the live rows of a dataset as one commit with fewer files; older
    commits stay for reads by version. The commit names the version that it read: rows appended
    meanwhile stay live beside it; any other change meanwhile refuses the compaction.

    ``files=None``: no shuffle. Spark packs small files into read splits of
    ``spark.sql.files.maxPartitionBytes``, one output file per split (and
    partition value). ``files=n``: a rebalancing shuffle by the partition columns, which Spark
    splits by measured bytes, so a hot partition value becomes several tasks.

    ``cluster_by``: up to seven columns; rows near in all of them come to lie in the same files (Z-order), so that a
    filter on any of them meets few files. One range shuffle by the partition columns and the
    key; ``files`` by default from the size of the data.
    """
    ds = checks.check_dataset_id(dataset_id)
    st = dataset_state(ctx, ds)
    if st is None or not st.exists:
        raise DatasetNotFoundError(f"no live dataset {ds}")
    if files is not None and (not isinstance(files, int) or files < 1):
        raise ValueError("files must be a positive int or None")
    near = [cluster_by] if isinstance(cluster_by, str) else list(cluster_by or [])
    kinds = {f.name: f.dataType for f in st.schema.fields}
    plain = (NumericType, StringType, DateType, TimestampType, TimestampNTZType)
    if bad := [c for c in near if not isinstance(kinds.get(c), plain)]:
        raise ValueError(f"cannot cluster by {bad}: unknown, or not of numbers, strings, dates or timestamps")
    if len(near) > 7:
        raise ValueError("cluster by seven columns at most")
    parts = st.partition_by
    df = read_state(ctx, st)
    columns = [F.col(f"`{c}`") for c in parts]
    if near:
        if files is None:
            sizes = fsys.each(lambda c: fsys.size_of(ctx.spark, ctx.commit_dir(ds, c.data_folder)) or (0, 0), st.live)
            files = max(1, sum(b for _, b in sizes) // _TARGET)
        place = f"_place_{uuid.uuid4().hex}"  # a column, so that the range bounds, the shuffle and the sort share it
        order = [*columns, F.col(place)]
        df = df.withColumn(place, z_order(df, near)).repartitionByRange(files, *order).sortWithinPartitions(*order).drop(place)
    elif files is not None:
        df = df.hint("rebalance", files, *columns) if parts else df.repartition(files)
    elif parts:
        df = df.sortWithinPartitions(*columns)
    cid = str(uuid.uuid4())
    folder = _folder_name(cid)
    return commit(ctx, CommitPlan(
        dataset_id=ds, commit_id=cid, requested="compact", mode="compact", frame=df, name=st.attrs["name"],
        description=st.attrs["description"], tags=dict(st.attrs["tags"] or {}), partition_by=parts, schema=st.schema,
        schema_id=st.attrs["schema_id"], fields=st.fields, inputs=[], data_folder=folder, folder=ctx.commit_dir(ds, folder),
        fmt=st.attrs["format"] or ctx.format, options={}, state=st, snapshot=st.version, skip_by=st.skip_by,
    ))
