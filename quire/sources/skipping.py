"""Data skipping: small statistics of every data file, and reads that load only files that can match.

A dataset may name columns (``skip_by``). Each commit then leaves a table with one row a file: per column the smallest and
largest value, the number of nulls, and a Bloom filter of the values. Statistics belong to files, which never
change: a replacement or merge only takes rows away, so they stay true; a compaction writes new ones.
Columns are named by their ids, so renames don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DataType, LongType, MapType, StringType, StructField, StructType, VariantType,
)

from quire.context import Context
from quire.errors import DatasetNotFoundError
from quire.functions import checks
from quire.sources.datasets import ZONE, DatasetState, Rows, dataset_state

BLOOM_BITS, HASHES = 1 << 17, 5  # of each file and column: at 13,000 values one stranger in 100 passes
_UNSORTED = (ArrayType, MapType, StructType, VariantType, BinaryType)


def check_skip_by(skip_by, schema: StructType) -> list[str]:
    names = [skip_by] if isinstance(skip_by, str) else list(skip_by or [])
    types = {f.name: f.dataType for f in schema.fields}
    for n in names:
        if n not in types:
            raise ValueError(f"unknown column {n!r} in skip_by")
        if isinstance(types[n], _UNSORTED):
            raise ValueError(f"column {n!r} is {types[n].simpleString()}; skip_by needs plain values")
    return names


def _column(number: int) -> str:
    return f"c{number}"


def _stats_schema(types: dict[int, DataType]) -> StructType:
    of = lambda t: StructType([
        StructField("lo", t), StructField("hi", t), StructField("nulls", LongType()), StructField("bloom", MapType(LongType(), LongType()))])
    return StructType([StructField("file", StringType()), StructField("n_rows", LongType()), *[StructField(_column(i), of(t)) for i, t in types.items()]])


def _places(value: Column) -> list[Column]:
    """Bits of a value in the filter."""
    return [F.pmod(F.xxhash64(F.lit(k), value), F.lit(BLOOM_BITS)) for k in range(HASHES)]


def write_stats(ctx: Context, dataset_id: str, folder: str, fields, schema: StructType, names: list[str], fmt: str) -> None:
    """Statistics of the files of one attempt: a scan of these columns, and partial aggregates a file."""
    where = f"{ctx.processed_dir(dataset_id)}/commit_id={folder}"
    df = ctx.spark.read.format(fmt).schema(fields.stored_schema(schema)).options(**ZONE).load(where)
    file = F.substring_index(df.metadataColumn("_metadata")["file_path"], "/Processed/", -1)
    cols = {fields.ids[n]: F.col(f"`{fields.stored[n]}`") for n in names}
    df = df.select(file.alias("file"), *[c.alias(_column(i)) for i, c in cols.items()])
    plain = df.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.struct(F.min(_column(i)).alias("lo"), F.max(_column(i)).alias("hi"), F.sum(F.col(_column(i)).isNull().cast("long")).alias("nulls"))
          .alias(_column(i)) for i in cols])
    # a row for each bit set, then a long for each 64 of them
    each = F.array(*[F.when(F.col(_column(i)).isNotNull(), F.struct(F.lit(i).alias("c"), F.array(*_places(F.col(_column(i)))).alias("p"))) for i in cols])
    bits = df.select("file", F.explode(each).alias("x")).filter("x is not null").select("file", "x.c", F.explode("x.p").alias("p"))
    words = bits.groupBy("file", "c", F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))
    blooms = words.groupBy("file").agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("c") == i, F.struct("w", "b")))).alias(f"b{i}") for i in cols])
    out = plain.join(blooms, "file", "left").select("file", "n_rows", *[
        F.struct(f"{_column(i)}.lo", f"{_column(i)}.hi", f"{_column(i)}.nulls", F.col(f"b{i}").alias("bloom")).alias(_column(i)) for i in cols])
    out.hint("rebalance").write.mode("overwrite").options(**ZONE).parquet(f"{ctx.stats_dir(dataset_id)}/commit_id={folder}")


def _literal(value, kind: DataType) -> Column:
    return F.lit(value).cast(kind)


def _in_bloom(stat: Column, value: Column) -> Column:
    """Whether the filter may hold the value; a word that is not there has no bit set."""
    hit = F.lit(True)
    for p in _places(value):
        word = F.coalesce(F.element_at(stat["bloom"], F.shiftright(p, 6)), F.lit(0).cast("long"))
        hit = hit & (F.getbit(word, (p % 64).cast("int")) == 1)
    return hit


def _bounds(wanted) -> tuple | None:
    return wanted if isinstance(wanted, tuple) else None


def _may_match(stat: Column, wanted, kind: DataType) -> Column:
    """Whether a file with these statistics can hold a row that is wanted; a file without them can."""
    if wanted is None:
        can = stat["nulls"] > 0
    elif (b := _bounds(wanted)) is not None:
        can = F.lit(True)
        if b[0] is not None:
            can = can & (stat["hi"] >= _literal(b[0], kind))
        if b[1] is not None:
            can = can & (stat["lo"] <= _literal(b[1], kind))
    else:
        values = wanted if isinstance(wanted, list) else [wanted]
        some = F.array(*[_literal(v, kind) for v in values if v is not None]).cast(ArrayType(kind))
        can = F.exists(some, lambda x: (stat["lo"] <= x) & (stat["hi"] >= x) & _in_bloom(stat, x))
        can = F.coalesce(can, F.lit(False)) | (stat["nulls"] > 0) if None in values else can
    # all values null: lo and hi are, and no value matches
    return stat.isNull() | F.coalesce(can, F.lit(False))


def _matches(column: Column, wanted, kind: DataType) -> Column:
    if wanted is None:
        return column.isNull()
    if (b := _bounds(wanted)) is not None:
        hit = column.isNotNull()
        hit = hit & (column >= _literal(b[0], kind)) if b[0] is not None else hit
        return hit & (column <= _literal(b[1], kind)) if b[1] is not None else hit
    values = wanted if isinstance(wanted, list) else [wanted]
    hit = column.isin([_literal(v, kind) for v in values if v is not None])
    return hit | column.isNull() if None in values else hit


def files_matching(ctx: Context, st: DatasetState, where: Mapping) -> DataFrame:
    """(file, n_rows) of the files with statistics that can hold rows wanted by ``where``."""
    ids, types = st.fields.ids, {f.name: f.dataType for f in st.schema.fields}
    kinds = {ids[n]: types[n] for n in where}
    rows = ctx.spark.read.schema(_stats_schema(kinds)).options(**ZONE).parquet(
        *[f"{ctx.stats_dir(st.dataset_id)}/commit_id={c.data_folder}" for c in st.live if c.stats])
    can = F.lit(True)
    for n, wanted in where.items():
        can = can & _may_match(F.col(_column(ids[n])), wanted, types[n])
    return rows.filter(can).select("file", "n_rows")


def read_where(ctx: Context, dataset_id: str, where: Mapping, version: int | None = None, as_of=None, **options) -> DataFrame:
    """Rows of a dataset that meet all of ``where``: by column a value, a list of values, a pair (low, high) as a
    tuple with ``None`` for an open end, both ends included, or ``None`` for null.

    Only files whose statistics allow a match are loaded; files of commits without statistics are. The rows are
    those of a read with the same filter. NaN counts as the largest value, as Spark has it.
    """
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    if not isinstance(where, Mapping) or not where:
        raise TypeError("where must be a non-empty mapping of columns")
    st = dataset_state(ctx, ds, version, as_of)
    if st is None or not st.exists:
        raise DatasetNotFoundError(f"no live dataset {ds}")
    types = {f.name: f.dataType for f in st.schema.fields}
    if unknown := [n for n in where if n not in types]:
        raise ValueError(f"unknown columns: {unknown}")
    for n, wanted in where.items():
        if isinstance(wanted, tuple) and len(wanted) != 2 or isinstance(wanted, float) and math.isnan(wanted):
            raise ValueError(f"column {n!r}: a range is a pair, and NaN is no value to look for")
    with_stats = {c.data_folder for c in st.live if c.stats}
    loaded = {}
    if with_stats and not any(isinstance(types[n], _UNSORTED) for n in where):
        root = ctx.processed_dir(ds)
        # names of the files to read, which Spark's reader takes from the driver; folders without statistics stay whole
        loaded = {f: [] for f in with_stats}
        for r in files_matching(ctx, st, where).select("file").toLocalIterator():
            name = unquote(r["file"])
            loaded[name.split("/", 1)[0].removeprefix("commit_id=")].append(f"{root}/{name}")
    live = [c for c in st.live if loaded.get(c.data_folder) != []]
    hit = F.lit(True)
    for n, wanted in where.items():
        hit = hit & _matches(F.col(f"`{n}`"), wanted, types[n])
    if not live:
        return ctx.spark.createDataFrame([], st.schema)
    hiders = [c for c in st.live if c.hides]
    rows = Rows(ctx, st, live, any(c.hidden for c in hiders), only=loaded, **options).hide(hiders)
    return rows.columns().filter(hit)
