"""The catalogue as numbered commits, one folder for each dataset.

``log/<dataset_id>/<version>.parquet`` holds one commit: its data folder, the dataset's
attributes as of then, and the version at which what readers see begins. A file is created only if its
number is free, so of two writers one gets it and the other looks again: the order of
commits is that of their numbers, whatever the writers' clocks say. A file may hold several
rows, for logs that were put together; it is named after its last version.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from datetime import datetime, timezone
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType, BooleanType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampType,
)

from quire.context import Context
from quire.sources import filesystem as fsys


def _struct(**fields) -> StructType:
    return StructType([StructField(k, t) for k, t in fields.items()])


COLUMN_TYPE = _struct(ordinal=IntegerType(), column_name=StringType(), data_type=StringType(), nullable=BooleanType())
CARRIED_TYPE = _struct(version=LongType(), commit_id=StringType(), data_folder=StringType(), mode=StringType())

LOG_SCHEMA = _struct(
    dataset_id=StringType(),
    version=LongType(),
    reset_version=LongType(),  # commits from here on are live, unless this one is a deletion
    carried=ArrayType(CARRIED_TYPE),  # of a compaction: earlier commits that stay live
    commit_id=StringType(),
    data_folder=StringType(),
    mode=StringType(),  # overwrite | append | replace | merge | compact | delete, without data: alter | expire | fence
    committed_at=TimestampType(),
    created_at=TimestampType(),
    n_rows=LongType(),
    total_rows=LongType(),  # of the dataset after this commit
    n_live=LongType(),
    replaced=StringType(),  # of a replacement: folder of the partition values that it replaces
    replace_where=StringType(),  # or a predicate on rows
    replace_zone=StringType(),  # session zone in which the predicate was given
    name=StringType(),
    description=StringType(),
    folder=StringType(),
    format=StringType(),
    partition_by=ArrayType(StringType()),
    tags=MapType(StringType(), ArrayType(StringType())),
    schema_id=StringType(),
    schema_json=StringType(),
    inputs=ArrayType(StringType()),
    n_replaced=LongType(),  # partition values in ``replaced``
    hidden=StringType(),  # of a merge: folder of the row positions that it hides
    n_hidden=LongType(),
    stats=BooleanType(),  # whether its files have statistics
    carried_stats=ArrayType(StringType()),  # folders of carried commits that have them
    skip_by=ArrayType(IntegerType()),  # ids of the columns that commits keep statistics of
    fields=StringType(),  # ids and stored names of the columns
    fenced=ArrayType(StringType()),  # attempts that may no longer commit
    expired_before=LongType(),  # versions before this one can no longer be read
)
SCHEMA_TABLE = _struct(schema_id=StringType(), schema_json=StringType(), columns=ArrayType(COLUMN_TYPE))
STARTED = _struct(folder=StringType(), dataset_id=StringType(), commit_id=StringType(), started_at=TimestampType())


def encode(rows: Sequence[dict], schema: StructType = LOG_SCHEMA) -> bytes:
    """Rows as the bytes of one small Parquet file; absent fields are null."""
    known = set(schema.fieldNames())
    out = []
    for row in rows:
        if unknown := set(row) - known:
            raise KeyError(f"unknown fields {sorted(unknown)}")
        row = {k: row.get(k) for k in known}
        if row.get("tags") is not None:
            row["tags"] = [(str(k), list(v)) for k, v in row["tags"].items()]
        for k, v in row.items():
            if isinstance(v, datetime) and v.tzinfo is None:
                row[k] = v.replace(tzinfo=timezone.utc)
        out.append(row)
    buf = pa.BufferOutputStream()
    pq.write_table(pa.Table.from_pylist(out, schema=to_arrow_schema(schema)), buf, compression="zstd")
    return buf.getvalue().to_pybytes()


def decode(data: bytes, schema: StructType = LOG_SCHEMA) -> list[dict]:
    """Rows of a small file; fields that it does not have are null."""
    absent = dict.fromkeys(schema.fieldNames())
    rows = [absent | r for r in pq.read_table(pa.BufferReader(data)).to_pylist()]
    for r in rows:
        if r.get("tags") is not None:
            r["tags"] = dict(r["tags"])
    return rows


def entry_path(ctx: Context, dataset_id: str, version: int) -> str:
    return f"{ctx.log_of(dataset_id)}/{version:012d}.parquet"


_HINT = "_at"  # holds a version that is there; the last one is at or behind it
_HINT_STEP = 16


def note_version(ctx: Context, dataset_id: str, version: int) -> None:
    """Leaves a hint where the log's end is, now and then. Nothing depends on it but the time of a lookup."""
    if version % _HINT_STEP == 0:
        fsys.put_bytes(ctx.spark, f"{ctx.log_of(dataset_id)}/{_HINT}", str(version).encode())


def _hinted(ctx: Context, dataset_id: str) -> int:
    data = fsys.read_bytes_if(ctx.spark, f"{ctx.log_of(dataset_id)}/{_HINT}")
    return int(data) if data and data.isdigit() else 0


def last_version(ctx: Context, dataset_id: str) -> int:
    """The highest version number of a dataset's log, 0 without one. Numbers follow one another, so from a number
    known to be there the last is found by doubling and bisection; a log that was put together
    from elsewhere, which may not have every number, is listed."""
    there = lambda v: fsys.exists(ctx.spark, entry_path(ctx, dataset_id, v))
    low = _hinted(ctx, dataset_id)
    if not low or not there(low):
        names = fsys.names_in(ctx.spark, ctx.log_of(dataset_id))
        return int(names[-1].split(".")[0]) if names else 0
    step = 1
    while there(low + step):
        low, step = low + step, step * 2
    high = low + step  # not there; numbers below it are looked for between
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if there(mid) else (low, mid)
    return low


def entries(ctx: Context, dataset_id: str, versions: Sequence[int]) -> list[dict] | None:
    """These commits, read one small file each; ``None`` when one has no file of its own."""
    files = fsys.each(lambda v: fsys.read_bytes_if(ctx.spark, entry_path(ctx, dataset_id, v)), versions)
    if any(f is None for f in files):
        return None
    rows = [decode(f) for f in files]
    return [r for rs in rows for r in rs] if all(len(rs) == 1 for rs in rows) else None


def last_entry(ctx: Context, dataset_id: str) -> dict | None:
    """The dataset's last commit: a few existence checks and one small file."""
    version = last_version(ctx, dataset_id)
    if not version:
        return None
    return max(decode(fsys.read_bytes(ctx.spark, entry_path(ctx, dataset_id, version))), key=lambda r: r["version"])


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_ONE_LISTING = threading.Lock()
_LISTERS = 64  # tasks that list a log of many folders; Spark's default is one for each folder


def _table(ctx: Context, path: str, schema: StructType) -> DataFrame:
    spark = ctx.spark
    if not fsys.exists(spark, path):
        return spark.createDataFrame([], schema)
    # files are listed here and now, so the setting holds for this listing alone; one thread at a time, so that
    # none takes another's value for the session's
    with _ONE_LISTING:
        before = spark.conf.get(_LISTING, None)
        spark.conf.set(_LISTING, str(_LISTERS))
        try:
            return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
        finally:
            if before is None:
                spark.conf.unset(_LISTING)
            else:
                spark.conf.set(_LISTING, before)


def dataset_log(ctx: Context, dataset_id: str) -> DataFrame:
    """All commits of one dataset."""
    return _table(ctx, ctx.log_of(dataset_id), LOG_SCHEMA)


def read_log(ctx: Context) -> DataFrame:
    """All commits of all datasets."""
    return _table(ctx, ctx.log_dir, LOG_SCHEMA)


def latest_log(ctx: Context) -> DataFrame:
    """Commits with the last one of each dataset among them. Files are named by their numbers, so where most commits are
    not the last of their dataset only the last files are opened; the names come from the listing that
    every read makes."""
    df = read_log(ctx)
    last: dict[str, str] = {}
    n = 0
    for f in df.inputFiles():
        folder, name = f.rsplit("/", 1)
        last[folder] = max(name, last.get(folder, ""))
        n += 1
    if n <= 2 * len(last):
        return df
    return ctx.spark.read.schema(LOG_SCHEMA).parquet(*[unquote(f"{folder}/{name}") for folder, name in last.items()])


def schema_table(ctx: Context) -> DataFrame:
    return _table(ctx, ctx.schemas_dir, SCHEMA_TABLE)


def started(ctx: Context) -> DataFrame:
    """Attempts that have begun and neither committed nor been undone."""
    return _table(ctx, ctx.started_dir, STARTED)
