"""Profiles against exact counts, and that each commit is scanned once."""

import random

import pytest

from quire import (
    compact_dataset, included_columns, key_columns, merge_rows, profile, profile_commits, publish, read_dataset, rename_column, replace_partition,
)
from quire.functions import profiles

KIND = "id long, near double, name string, day date, xs array<int>"


def _rows(lo, hi, rng):
    import datetime

    return [(i, rng.gauss(0, 1) if i % 10 else None, f"n{i % 700}", datetime.date(2024, 1, 1) + datetime.timedelta(days=i % 90), [i]) for i in range(lo, hi)]


@pytest.fixture()
def made(ctx, spark):
    rng = random.Random(5)
    ds = publish(ctx, spark.createDataFrame(_rows(0, 6000, rng), KIND), "p", "profiles")["dataset_id"]
    publish(ctx, spark.createDataFrame(_rows(6000, 9000, rng), KIND), "p", "profiles", dataset_id=ds, mode="append")
    return ds


def test_counts_and_quantiles_within_their_bounds(ctx, made):
    got = {r["column_name"]: r for r in profile(ctx, made).collect()}
    assert {n: (r["n_rows"], r["n_nulls"]) for n, r in got.items()} == {n: (9000, 900 if n == "near" else 0) for n in ("id", "near", "name", "day", "xs")}
    for n, exact in (("id", 9000), ("near", 8100), ("name", 700), ("day", 90)):
        assert abs(got[n]["n_distinct"] - exact) <= 0.05 * exact
    assert got["xs"]["n_distinct"] is None and got["xs"]["quantiles"] is None and got["name"]["quantiles"] is None
    values = sorted(r[0] for r in read_dataset(ctx, made).select("near").collect() if r[0] is not None)
    for q, v in zip(profiles.QUANTILES, got["near"]["quantiles"]):
        rank = sum(x <= v for x in values) / len(values)
        assert abs(rank - q) <= 0.03
    assert got["id"]["quantiles"][0] == 0 and got["id"]["quantiles"][-1] == 8999 and not got["id"]["hides"]


def test_each_commit_is_scanned_once(ctx, spark, made):
    assert profile_commits(ctx, made) == 2 and profile_commits(ctx, made) == 0
    publish(ctx, spark.createDataFrame([(-1, 0.5, "x", None, None)], KIND), "p", "profiles", dataset_id=made, mode="append")
    rename_column(ctx, made, "name", "title")
    assert profile_commits(ctx, made) == 1
    got = {r["column_name"]: r["n_rows"] for r in profile(ctx, made).collect()}
    assert got == dict.fromkeys(("id", "near", "title", "day", "xs"), 9001)
    publish(ctx, spark.createDataFrame([(-2, "new")], "id long, more string"), "p", "profiles", dataset_id=made, mode="append", mergeSchema=True)
    got = {r["column_name"]: (r["n_rows"], r["n_nulls"]) for r in profile(ctx, made).collect()}
    assert got["more"] == (9002, 9001) and got["near"] == (9002, 901)
    compact_dataset(ctx, made)
    assert {r["column_name"]: (r["n_rows"], r["n_nulls"]) for r in profile(ctx, made).collect()} == got


def test_keys_and_inclusions_are_confirmed(ctx, spark, made):
    assert key_columns(ctx, made) == ["id"]
    other = spark.createDataFrame([(i, f"n{i % 300}", 0.5) for i in range(0, 4000, 2)], "ref long, name string, near double")
    small = publish(ctx, other, "q", "some")["dataset_id"]
    assert set(included_columns(ctx, small, made)) == {("ref", "id"), ("name", "name")}
    publish(ctx, spark.createDataFrame([(10**9, "n1", 0.5)], "ref long, name string, near double"), "q", "some", dataset_id=small, mode="append")
    assert set(included_columns(ctx, small, made)) == {("name", "name")}  # one value is enough
    publish(ctx, spark.createDataFrame([(5, 0.1, "n", None, None)], KIND), "p", "profiles", dataset_id=made, mode="append")
    assert key_columns(ctx, made) == []  # so is one repeat
    merge_rows(ctx, spark.createDataFrame([(5, 0.1, "n5", None, None)], KIND), made, "id")
    assert key_columns(ctx, made) == ["id"]  # hidden rows don't count


def test_empty_dataset(ctx, spark):
    ds = publish(ctx, spark.createDataFrame([], KIND), "e", "empty")["dataset_id"]
    assert profile(ctx, ds).count() == 0 or {r["n_rows"] for r in profile(ctx, ds).collect()} == {0}
    replace_partition(ctx, spark.createDataFrame([(1, None, None, None, None)], KIND), ds, "id = 1")
    got = {r["column_name"]: r for r in profile(ctx, ds).collect()}
    assert got["near"]["quantiles"] is None and got["near"]["n_nulls"] == 1 and got["id"]["n_distinct"] == 1


def test_distinct_counts_are_exact_and_dealt_out(ctx, made, monkeypatch):
    """Exact counts without a row for each column of each row; many values are dealt to tasks of few rows first."""
    want = {"id": 9000, "near": 8100, "name": 700, "day": 90}
    for dealt in (profiles.DEALT, 1000):
        monkeypatch.setattr(profiles, "DEALT", dealt)
        counts = profiles.distinct_counts(ctx, made)
        assert {r["column_name"]: r["n"] for r in counts.collect()} == want
        plan = counts._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and plan.count("Repartition ") == (2 if dealt == 1000 else 0)
        assert key_columns(ctx, made) == ["id"]
