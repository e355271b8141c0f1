"""Columns renamed, dropped, added again and widened, over commits from before and after."""

from collections import Counter
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quire import (
    compact_dataset, drop_column, merge_rows, publish, read_dataset, rename_column, replace_partition, widen_column,
)
from quire.operators import alter, publish as publish_module
from quire.sources.datasets import dataset_state


def _rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture()
def made(ctx, spark):
    df = spark.createDataFrame([(i, f"t{i}", i % 3) for i in range(9)], "a int, b string, p int")
    return publish(ctx, df, "x", "columns", partition_by="p")["dataset_id"]


def _append(ctx, spark, ds, rows, schema, **kw):
    out = publish(ctx, spark.createDataFrame(rows, schema), "x", "columns", dataset_id=ds, mode="append", **kw)
    assert out["accepted"], out


def test_rename_drop_add_again_widen(ctx, spark, made):
    assert rename_column(ctx, made, "b", "c")["version"] == 2
    _append(ctx, spark, made, [(100, "new", 0)], "a int, c string, p int")
    assert read_dataset(ctx, made).columns == ["a", "c", "p"]
    assert drop_column(ctx, made, "a")["accepted"]
    _append(ctx, spark, made, [("x", 1)], "c string, p int")
    _append(ctx, spark, made, [("y", 1, 5)], "c string, p int, a int", mergeSchema=True)
    got = read_dataset(ctx, made)
    assert got.columns == ["c", "p", "a"]
    want = Counter([(f"t{i}", i % 3, None) for i in range(9)] + [("new", 0, None), ("x", 1, None), ("y", 1, 5)])
    assert _rows(got) == want
    # a filter that reaches the files must not meet the values of the column that was dropped
    assert got.filter("a is null").count() == 11 and got.filter("a >= 0").count() == 1
    assert widen_column(ctx, made, "a", "bigint")["accepted"]
    _append(ctx, spark, made, [("z", 2, 1 << 40)], "c string, p int, a long")
    assert {r[0] for r in read_dataset(ctx, made).filter("a > 4").collect()} == {"y", "z"}
    want |= Counter([("z", 2, 1 << 40)])
    assert _rows(read_dataset(ctx, made)) == want
    assert read_dataset(ctx, made, version=1).columns == ["a", "b", "p"]
    assert compact_dataset(ctx, made)["accepted"]
    assert _rows(read_dataset(ctx, made)) == want
    files = [f for f in read_dataset(ctx, made).inputFiles() if f.endswith(".parquet")]
    assert set(pq.read_schema(files[0].removeprefix("file://")).names) == {"b", "a__4"}  # stored names stay


def test_footers_hold_the_ids(ctx, spark, made):
    ids = lambda: {
        pq.read_schema(f.removeprefix("file://")).field(n).metadata[b"PARQUET:field_id"]
        for f in read_dataset(ctx, made).inputFiles() for n in pq.read_schema(f.removeprefix("file://")).names if n == "b"}
    assert ids() == {b"2"}
    rename_column(ctx, made, "b", "other")
    _append(ctx, spark, made, [(1, "u", 0)], "a int, other string, p int")
    assert ids() == {b"2"}  # still the stored name and the id
    assert dataset_state(ctx, made).fields.ids == {"a": 1, "other": 2, "p": 3}


def test_names_swapped(ctx, spark):
    ds = publish(ctx, spark.createDataFrame([(1, 2)], "a int, b int"), "x", "swap")["dataset_id"]
    for old, new in (("a", "tmp"), ("b", "a"), ("tmp", "b")):
        assert rename_column(ctx, ds, old, new)["accepted"]
    assert read_dataset(ctx, ds).filter("b = 1").first().asDict() == {"b": 1, "a": 2}
    assert rename_column(ctx, ds, "a", "A")["accepted"] and read_dataset(ctx, ds).columns == ["b", "A"]


def test_merge_and_replacement_after_a_rename(ctx, spark, made):
    rename_column(ctx, made, "a", "k")
    src = spark.createDataFrame([(4, "merged", 1)], "k int, b string, p int")
    assert merge_rows(ctx, src, made, "k")["accepted"]
    assert replace_partition(ctx, src.withColumn("p", F.lit(2)), made, "p = 2")["accepted"]
    assert replace_partition(ctx, src.filter("k = 0"), made, "k = 0")["accepted"]
    assert rename_column(ctx, made, "k", "key")["accepted"]  # places do not name columns
    want = Counter([(i, f"t{i}", i % 3) for i in range(9) if i % 3 != 2 and i not in (0, 4)] + [(4, "merged", 1), (4, "merged", 2)])
    assert _rows(read_dataset(ctx, made)) == want


def test_refusals(ctx, spark, made, monkeypatch):
    for out in (
        rename_column(ctx, made, "p", "q"), drop_column(ctx, made, "p"), rename_column(ctx, made, "a", "B"), drop_column(ctx, made, "zz"),
        rename_column(ctx, made, "a", "commit_id"), widen_column(ctx, made, "a", "string"), widen_column(ctx, made, "b", "int"),
    ):
        assert out["error_type"] == "SchemaMismatchError", out
    assert drop_column(ctx, made, "a")["accepted"] and not drop_column(ctx, made, "b")["accepted"]
    monkeypatch.setattr(publish_module, "BROADCAST_ROWS", 0)  # the predicate is stored as it is
    replace_partition(ctx, spark.createDataFrame([("t1", 1)], "b string, p int"), made, "b = 't1'")
    assert "compact" in rename_column(ctx, made, "b", "c")["error"]
    assert read_dataset(ctx, made).count() == 9
    assert rename_column(ctx, "0f4b6a0e-51c5-4f53-8a3a-6f6a6d1f9b21", "a", "b")["error_type"] == "DatasetNotFoundError"
    with pytest.raises(TypeError):
        drop_column(ctx, "no id", "a")


def test_an_append_under_way_meets_the_new_schema(ctx, spark, made):
    def other(**_):
        ctx.hooks.clear()
        rename_column(ctx, made, "a", "k")

    ctx.hooks["register"] = other
    out = publish(ctx, spark.createDataFrame([(1, "u", 0)], "a int, b string, p int"), "x", "columns", dataset_id=made, mode="append")
    assert out["error_type"] == "SchemaMismatchError" and read_dataset(ctx, made).count() == 9


VALUES = {
    "tinyint": [-7, 7], "smallint": [-300, 300], "int": [-70000, 70000], "float": [1.5, -2.25],
    "date": [date(2020, 2, 29), date(1969, 1, 1)],
}


@pytest.mark.parametrize("text", alter.READ_WIDER)
def test_each_widening_reads_older_files(ctx, spark, text):
    narrow, wide = text.split("->")
    rows = [(v,) for v in VALUES[narrow]] + [(None,)]
    df = spark.createDataFrame(rows, f"v {'date' if narrow == 'date' else 'double' if narrow == 'float' else 'int'}")
    df = df.select(F.col("v").cast(narrow))
    ds = publish(ctx, df, "x", "wide")["dataset_id"]
    assert widen_column(ctx, ds, "v", wide)["accepted"]
    got = read_dataset(ctx, ds)
    assert dict(got.dtypes)["v"] == wide
    want = [datetime(v.year, v.month, v.day) if narrow == "date" else v for v in VALUES[narrow]]
    assert sorted(r[0] for r in got.collect() if r[0] is not None) == sorted(want)
    top = max(want)
    assert got.filter(F.col("v") == F.lit(top).cast(wide)).count() == 1 and got.filter("v is null").count() == 1


def test_decimals_widen(ctx, spark):
    ds = publish(ctx, spark.sql("select cast(1.25 as decimal(5,2)) v"), "x", "dec")["dataset_id"]
    assert not widen_column(ctx, ds, "v", "decimal(5,3)")["accepted"]
    assert widen_column(ctx, ds, "v", "decimal(12,4)")["accepted"]
    assert str(read_dataset(ctx, ds).filter("v > 1").first()[0]) == "1.2500"
