"""Column lineage of a join, an aggregate, a window, a union, generators and functions the plan hides."""

import pytest
from pyspark.sql import Window, functions as F

from quire import column_lineage, publish, read_dataset


@pytest.fixture()
def two(ctx, spark):
    a = spark.createDataFrame([(1, 2, "x", [1])], "k long, v long, s string, xs array<int>")
    b = spark.createDataFrame([(1, 5)], "k long, w long")
    ids = [publish(ctx, df, n, n)["dataset_id"] for n, df in (("a", a), ("b", b))]
    return ids, *[read_dataset(ctx, i) for i in ids]


def _edges(ctx, df, ids):
    names = dict(zip(ids, "ab"))
    return {(r["column_name"], names.get(r["input_dataset_id"]), r["input_column"], r["how"]) for r in column_lineage(ctx, df).collect()}


def test_projection_join_and_constant(ctx, two):
    ids, a, b = two
    df = a.join(b, "k").select("k", (F.col("v") + F.col("w")).alias("sum"), F.col("s").alias("t"), F.lit(1).alias("one"))
    assert _edges(ctx, df, ids) == {("k", "a", "k", "direct"), ("sum", "a", "v", "derived"), ("sum", "b", "w", "derived"), ("t", "a", "s", "direct")}


def test_self_join_and_nested_columns(ctx, two):
    ids, a, _ = two
    df = a.alias("x").join(a.alias("y"), F.col("x.k") == F.col("y.v")).select(F.col("x.s"), F.struct("y.k", "x.v").alias("both"))
    assert _edges(ctx, df, ids) == {("s", "a", "s", "direct"), ("both", "a", "k", "derived"), ("both", "a", "v", "derived")}


def test_aggregate_and_window(ctx, two):
    ids, a, _ = two
    agg = a.groupBy(F.upper("s").alias("g")).agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    assert _edges(ctx, agg, ids) == {("g", "a", "s", "derived"), ("total", "a", "v", "derived")}
    win = a.withColumn("before", F.lag("v").over(Window.partitionBy("s").orderBy("k"))).select("k", "before")
    assert ("before", "a", "v", "derived") in _edges(ctx, win, ids) and ("k", "a", "k", "direct") in _edges(ctx, win, ids)


def test_union_and_explode(ctx, two):
    ids, a, b = two
    df = a.select("k", "v").union(b.select("k", "w"))
    assert _edges(ctx, df, ids) == {("k", "a", "k", "direct"), ("k", "b", "k", "direct"), ("v", "a", "v", "direct"), ("v", "b", "w", "direct")}
    df = a.select("k", F.explode("xs").alias("x"))
    assert _edges(ctx, df, ids) == {("k", "a", "k", "direct"), ("x", "a", "xs", "derived")}


def test_hidden_parts_are_marked(ctx, spark, two):
    ids, a, _ = two
    udf = F.udf(lambda v: v + 1, "long")
    assert _edges(ctx, a.select("k", udf("v").alias("u")), ids) == {("k", "a", "k", "direct"), ("u", "a", "v", "derived"), ("u", None, None, "unknown")}
    df = a.select("k", "v").mapInArrow(lambda it: it, "k long, z long")
    got = _edges(ctx, df, ids)
    assert {("k", None, None, "unknown"), ("z", None, None, "unknown"), ("z", "a", "v", "derived")} <= got
    memory = spark.createDataFrame([(1, 2)], "k long, m long").join(a, "k").select("m", "v")
    assert _edges(ctx, memory, ids) == {("m", None, None, "unknown"), ("v", "a", "v", "direct")}
