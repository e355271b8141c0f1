"""Column profiles that merge: sketches of each commit, united over the live ones without a rescan.

A commit's profile holds, for each column, its rows and nulls, a HyperLogLog sketch of its distinct values and, for numbers,
dates and timestamps, a KLL sketch of its quantiles. Commits never change, so each is scanned once; columns are named by
their ids. Keys and inclusions are guessed from the sketches, then confirmed on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType, LongType, MapType, StringType, StructField,
    StructType, TimestampNTZType, TimestampType, VariantType,
)

from quire.context import Context
from quire.errors import DatasetNotFoundError
from quire.functions import checks
from quire.sources import filesystem as fsys
from quire.sources.datasets import DatasetState, Rows, dataset_state, read_state

LG_K, KLL_K = 12, 200  # sizes of the sketches: distinct counts within 1.6 % (one standard error), ranks within 1.7 %
SLACK = 0.06  # what a sketch may be off where a key or an inclusion is guessed
DEALT = 1 << 20  # a column with more distinct values has no more rows than this counted by one task at first
QUANTILES = [0.0, 0.25, 0.5, 0.75, 1.0]
_PART = StructType([
    StructField("n_rows", LongType()), StructField("n_nulls", LongType()), StructField("distinct", BinaryType()), StructField("ranks", BinaryType())])


def _state(ctx: Context, dataset_id) -> DatasetState:
    ds = checks.check_dataset_id(dataset_id)
    if ds is None:
        raise TypeError("dataset_id must be a UUID")
    st = dataset_state(ctx, ds)
    if st is None or not st.exists:
        raise DatasetNotFoundError(f"no live dataset {ds}")
    return st


def _countable(kind: DataType) -> bool:
    return not isinstance(kind, (ArrayType, MapType, StructType, VariantType))


def _as_key(c: Column, kind: DataType) -> Column:
    """What is counted: whole numbers as such, all else as text, so that columns of two datasets compare."""
    return c.cast("long") if isinstance(kind, IntegralType) else c if isinstance(kind, StringType) else c.cast("string")


def _as_number(c: Column, kind: DataType) -> Column | None:
    if isinstance(kind, (IntegralType, FloatType, DoubleType, DecimalType)):
        return c.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.to_timestamp_ltz(c.cast("string"))).cast("double")
    return None


def _path(ctx: Context, ds: str, folder: str) -> str:
    return f"{ctx.profiles_dir(ds)}/commit_id={folder}"


def profile_commits(ctx: Context, dataset_id) -> int:
    """Profiles the live commits that have no profile yet, in one scan of these; returns how many there were."""
    return _profile(ctx, _state(ctx, dataset_id))


def _profile(ctx: Context, st: DatasetState) -> int:
    have = set(fsys.names_in(ctx.spark, ctx.profiles_dir(st.dataset_id)))
    todo = [c for c in st.live if f"commit_id={c.data_folder}" not in have]
    if not todo:
        return 0
    rows, ids = Rows(ctx, st, todo).df, st.fields.ids
    aggs = []
    for f in st.schema.fields:
        c = F.col(f"`{f.name}`")
        number = _as_number(c, f.dataType)
        aggs.append(F.struct(
            F.count(F.lit(1)).alias("n_rows"), F.count(F.when(c.isNull(), 1)).alias("n_nulls"),
            (F.hll_sketch_agg(_as_key(c, f.dataType), LG_K) if _countable(f.dataType) else F.lit(None).cast("binary")).alias("distinct"),
            (F.kll_sketch_agg_double(number, F.lit(KLL_K)) if number is not None else F.lit(None).cast("binary")).alias("ranks"),
        ).alias(f"c{ids[f.name]}"))
    rows.groupBy("commit_id").agg(*aggs).write.mode("append").partitionBy("commit_id").parquet(ctx.profiles_dir(st.dataset_id))
    return len(todo)


def _parts(ctx: Context, st: DatasetState) -> DataFrame:
    """(column, n_rows, n_nulls, distinct, ranks) of each live commit; a commit without the column has nulls there."""
    _profile(ctx, st)
    ids = st.fields.ids
    schema = StructType([StructField(f"c{i}", _PART) for i in ids.values()])
    folders = [_path(ctx, st.dataset_id, c.data_folder) for c in st.live]
    there = set(fsys.names_in(ctx.spark, ctx.profiles_dir(st.dataset_id)))
    folders = [f for f in folders if f.rsplit("/", 1)[1] in there]  # a commit without rows has none
    if not folders:
        return ctx.spark.createDataFrame([], StructType([StructField("column_name", StringType()), *_PART.fields]))
    # two runs at once may have profiled a commit twice: one of them counts
    rows = ctx.spark.read.schema(schema).option("basePath", ctx.profiles_dir(st.dataset_id)).parquet(*folders)
    rows = rows.dropDuplicates(["commit_id"])
    size = F.coalesce(*[F.col(f"c{i}.n_rows") for i in ids.values()])
    each = F.array(*[
        F.struct(F.lit(n).alias("column_name"), size.alias("n_rows"), F.coalesce(F.col(f"c{i}.n_nulls"), size).alias("n_nulls"),
                 F.col(f"c{i}.distinct").alias("distinct"), F.col(f"c{i}.ranks").alias("ranks")) for n, i in ids.items()])
    return rows.select(F.explode(each).alias("x")).select("x.*")


def profile(ctx: Context, dataset_id) -> DataFrame:
    """column_name, n_rows, n_nulls, n_distinct (estimate), quantiles (least, quarters and largest, as doubles; dates as days,
    timestamps as microseconds since 1970; null for other types), hides: whether live commits hide rows, which
    are still counted here, so that counts are upper bounds until a compaction."""
    st = _state(ctx, dataset_id)
    ranks = F.kll_merge_agg_double("ranks")
    out = _parts(ctx, st).groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.when(F.count("distinct") > 0, F.hll_sketch_estimate(F.hll_union_agg("distinct"))).alias("n_distinct"),
        ranks.alias("ranks"), F.count("ranks").alias("k"))
    quantiles = F.when((F.col("k") > 0) & (F.col("n_nulls") < F.col("n_rows")), F.kll_sketch_get_quantile_double(
        "ranks", F.array(*[F.lit(q) for q in QUANTILES])))
    return out.select("column_name", "n_rows", "n_nulls", "n_distinct", quantiles.alias("quantiles"), F.lit(any(c.hides for c in st.live)).alias("hides"))


def _by_value(rows: DataFrame, name: str, estimate: Row) -> DataFrame:
    """(v, n): each value of the column and how often it occurs. What a task holds does not grow with the table: few values
    are counted as the rows come; rows of a column of many are dealt out first, without regard to their values."""
    values = rows.select(F.col(f"`{name}`").alias("v"))
    if (estimate["n_distinct"] or 0) > DEALT:
        tasks = -(-estimate["n_rows"] // DEALT)
        values = values.repartition(max(tasks, rows.sparkSession.sparkContext.defaultParallelism))
    return values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(ctx: Context, dataset_id) -> DataFrame:
    """column_name, n: the exact number of distinct values, without null, of every column that can be counted."""
    st = _state(ctx, dataset_id)
    estimates = {r["column_name"]: r for r in profile(ctx, st.dataset_id).collect()}
    rows, out = read_state(ctx, st), None
    for f in st.schema.fields:
        if _countable(f.dataType):
            # live commits without rows have no profile
            values = _by_value(rows, f.name, estimates.get(f.name, {"n_rows": 0, "n_distinct": 0}))
            part = values.agg(F.count("v").alias("n")).select(F.lit(f.name).alias("column_name"), "n")
            out = part if out is None else out.unionByName(part)
    return ctx.spark.createDataFrame([], "column_name string, n long") if out is None else out


def key_columns(ctx: Context, dataset_id) -> list[str]:
    """Columns without nulls whose values are all different: those that the sketches allow, each confirmed by one
    aggregation of that column alone."""
    st = _state(ctx, dataset_id)
    guess = F.col("n_distinct") >= (1 - SLACK) * F.col("n_rows")
    if not any(c.hides for c in st.live):  # else hidden rows, also nulls and repeats, are in the counts
        guess = guess & (F.col("n_nulls") == 0)
    else:
        guess = F.lit(True)
    maybe = {r["column_name"]: r for r in profile(ctx, st.dataset_id).filter(guess).collect()}
    rows, out = read_state(ctx, st), []
    for f in st.schema.fields:
        if f.name in maybe and _countable(f.dataType):
            if _by_value(rows, f.name, maybe[f.name]).filter("n > 1 or v is null").isEmpty():
                out.append(f.name)
    return out


def included_columns(ctx: Context, dataset_id, other_id) -> list[tuple[str, str]]:
    """Pairs (column, column of the other dataset) of equal types such that all values of the first but null are values of the second:
    those that the sketches of both and of their union allow, each confirmed by one anti-join."""
    a, b = _state(ctx, dataset_id), _state(ctx, other_id)
    side = lambda st, k: _parts(ctx, st).groupBy("column_name").agg(F.hll_union_agg("distinct").alias("h")).select(
        F.col("column_name").alias(k), F.col("h").alias(f"{k}_h")).filter(F.col(f"{k}_h").isNotNull())
    kinds = lambda st: {f.name: f.dataType.simpleString() for f in st.schema.fields if _countable(f.dataType)}
    ka, kb = kinds(a), kinds(b)
    same = ctx.spark.createDataFrame([(x, y) for x in ka for y in kb if ka[x] == kb[y]], "a string, b string")
    both = same.join(side(a, "a"), "a").join(side(b, "b"), "b")
    union, alone = F.hll_sketch_estimate(F.hll_union("a_h", "b_h")), F.hll_sketch_estimate("b_h")
    maybe = both.filter((F.hll_sketch_estimate("a_h") > 0) & (union <= (1 + SLACK) * alone + 1)).select("a", "b").collect()
    left, right, out = read_state(ctx, a), read_state(ctx, b), []
    for x, y in sorted(map(tuple, maybe)):
        values = left.select(F.col(f"`{x}`").alias("v")).filter("v is not null").distinct()
        if values.join(right.select(F.col(f"`{y}`").alias("v")), "v", "left_anti").isEmpty():
            out.append((x, y))
    return out
