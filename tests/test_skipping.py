"""Reads that load only files that can match, and clustering that lets fewer match."""

import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quire import compact_dataset, merge_rows, publish, read_dataset, read_where, rename_column, replace_partition
from quire.sources import skipping
from quire.sources.datasets import dataset_state

KIND = "k long, x double, s string, d date, t timestamp_ntz, p string"


def _rows(df):
    return Counter(str(r) for r in df.collect())


def _files(df):
    return {f for f in df.inputFiles() if "/Processed/" in f}


@pytest.fixture()
def made(ctx, spark):
    rng = random.Random(1)
    rows = [(i, rng.random() if i % 7 else None, f"s{i % 50:03d}", date(2024, 1, 1 + i % 28), datetime(2024, 1, 1, i % 24), "a b=%{c}"[i % 2 :]) for i in range(400)]
    df = spark.createDataFrame(rows, KIND).repartitionByRange(8, "k")
    out = publish(ctx, df, "s", "skipping", partition_by="p", skip_by=["k", "x", "s", "d", "t", "p"])
    assert out["accepted"], out
    return out["dataset_id"]


WHERES = [
    {"k": 17}, {"k": -5}, {"k": [3, 390, None]}, {"k": (100, 120)}, {"k": (None, 10), "s": "s003"}, {"x": None}, {"x": (0.9, None)}, {"s": "nope"},
    {"s": ["s001", "s049"]}, {"d": date(2024, 1, 5)}, {"t": (datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 6))}, {"p": "a b=%{c}", "k": (0, 50)}, {"s": None},
]


def _plain(df, where):
    for n, w in where.items():
        c = F.col(n)
        if w is None:
            df = df.filter(c.isNull())
        elif isinstance(w, tuple):
            df = df.filter((c >= F.lit(w[0]) if w[0] is not None else c.isNotNull()) & (c <= F.lit(w[1]) if w[1] is not None else c.isNotNull()))
        else:
            vals = w if isinstance(w, list) else [w]
            hit = c.isin([v for v in vals if v is not None])
            df = df.filter(hit | c.isNull() if None in vals else hit)
    return df


def _same(ctx, ds, wheres=WHERES):
    for w in wheres:
        assert _rows(read_where(ctx, ds, w)) == _rows(_plain(read_dataset(ctx, ds), w)), w


def test_same_rows_fewer_files(ctx, made):
    _same(ctx, made)
    every = _files(read_dataset(ctx, made))
    assert len(_files(read_where(ctx, made, {"k": 17}))) == 1
    assert len(_files(read_where(ctx, made, {"k": (100, 120)}))) < len(every) / 2
    assert _files(read_where(ctx, made, {"s": "nope"})) == set()
    # a value inside the bounds of every file that none has
    assert _files(read_where(ctx, made, {"x": 0.5})) == set()


def test_after_other_commits(ctx, spark, made):
    row = lambda k, s, p: (k, 0.5, s, date(2024, 2, 1), datetime(2024, 2, 1), p)
    frame = lambda rows: spark.createDataFrame(rows, KIND)
    merge_rows(ctx, frame([row(17, "merged", "b"), row(1000, "s001", "b")]), made, "k")
    _same(ctx, made, [{"k": 17}, {"s": "merged"}, {"s": "s001"}, {"k": (900, None)}])
    replace_partition(ctx, frame([row(5, "fresh", " b=%{c}")]), made, "p = ' b=%{c}'")
    _same(ctx, made, [{"k": 5}, {"s": "fresh"}, {"k": 17}, {"p": " b=%{c}"}])
    publish(ctx, frame([row(2000, "s001", "b")]), "s", "skipping", dataset_id=made, mode="append", skip_by=[])  # without statistics
    _same(ctx, made, [{"k": 2000}, {"s": "s001"}])
    rename_column(ctx, made, "k", "key")
    assert read_where(ctx, made, {"k": 3}, version=1).count() == 1
    st = dataset_state(ctx, made)
    assert [c.stats for c in st.live] == [True, True, True, False]


def test_compaction_keeps_statistics_and_clustering_parts_files(ctx, spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.randrange(10_000), rng.randrange(10_000), f"v{i}") for i in range(4000)], "a long, b long, v string").repartition(16)
    ds = publish(ctx, df, "z", "cluster", skip_by=["a", "b"])["dataset_id"]
    box = {"a": (1000, 2000), "b": (7000, 8000)}
    want = _rows(_plain(read_dataset(ctx, ds), box))
    before = len(_files(read_where(ctx, ds, box)))
    out = compact_dataset(ctx, ds, files=16, cluster_by=["a", "b"])
    assert out["accepted"], out
    after = _files(read_where(ctx, ds, box))
    assert before == 16 and len(after) <= 4, (before, len(after))
    assert len(_files(read_where(ctx, ds, {"b": (7000, 7100)}))) <= 8
    assert _rows(read_where(ctx, ds, box)) == want and read_dataset(ctx, ds).count() == 4000


def test_cluster_by_all_kinds(ctx, spark, made):
    want = _rows(read_dataset(ctx, made))
    assert compact_dataset(ctx, made, files=4, cluster_by=["s", "d", "t", "x"])["accepted"]
    assert _rows(read_dataset(ctx, made)) == want
    assert compact_dataset(ctx, made, cluster_by="k")["accepted"]
    with pytest.raises(ValueError):
        compact_dataset(ctx, made, cluster_by="zz")


def test_no_value_is_missed_by_a_full_filter(ctx, spark, monkeypatch):
    monkeypatch.setattr(skipping, "BLOOM_BITS", 64)
    df = spark.createDataFrame([(f"v{i}",) for i in range(300)], "s string").repartition(3)
    ds = publish(ctx, df, "b", "bloom", skip_by="s")["dataset_id"]
    assert read_where(ctx, ds, {"s": [f"v{i}" for i in range(300)]}).count() == 300


def test_arguments(ctx, spark, made):
    df = spark.createDataFrame([([1],)], "a array<int>")
    with pytest.raises(ValueError):
        publish(ctx, df, "b", "bad", skip_by="a")
    for bad in ({}, None):
        with pytest.raises(TypeError):
            read_where(ctx, made, bad)
    with pytest.raises(ValueError):
        read_where(ctx, made, {"nope": 1})
    with pytest.raises(ValueError):
        read_where(ctx, made, {"k": (1, 2, 3)})


def test_ranks_by_binary_search(spark):
    """Eight steps a row, whatever the number of bounds, with the counts of a comparison with each."""
    from pyspark.sql import functions as F
    from quire.operators.maintain import _rank

    values = [float("-inf"), -3.5, -0.0, 0.0, 1.0, 1.5, 254.0, 255.0, 1e300, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for n in (0, 1, 2, 7, 128, 254, 255):
        steps = [i / 2 - 3 for i in range(n)]
        for r in df.select("x", _rank(F.col("x"), steps).alias("rank")).filter("x is not null").collect():
            assert r["rank"] == sum(not r["x"] < s for s in steps)  # NaN is the largest
    assert "filter" not in str(_rank(F.col("x"), [1.0, 2.0]))
