"""Changes between versions against the versions themselves, and retention."""

from collections import Counter
from datetime import datetime, timezone

import pytest

from quire import (
    VersionExpiredError, compact_dataset, delete_dataset, drop_column, expire_versions, merge_rows, publish, read_changes, read_dataset,
    rename_column, replace_partition,
)
from quire.sources import filesystem as fsys
from quire.sources.datasets import dataset_state

KIND = "k long, p string, v string"


def _frame(spark, rows, kind=KIND):
    return spark.createDataFrame(rows, kind).repartition(2)


def _rows(df):
    return Counter(map(tuple, df.collect()))


def _check(ctx, ds, a, b):
    target = read_dataset(ctx, ds, version=b)
    old = read_dataset(ctx, ds, version=a) if a else target.limit(0)
    names = dataset_state(ctx, ds, b).fields.ids
    was = {i: n for n, i in dataset_state(ctx, ds, a).fields.ids.items()} if a else {}
    old = old.selectExpr(*[f"`{was[i]}` as `{n}`" if i in was else f"null as `{n}`" for n, i in names.items() if n in target.columns]) if a else old
    old = old.select(target.columns)
    x, y = _rows(old), _rows(target)
    got = read_changes(ctx, ds, a, b)
    added = _rows(got.filter("_change = 'added'").drop("_change"))
    removed = _rows(got.filter("_change = 'removed'").drop("_change"))
    assert added == y - x and removed == x - y, (a, b)


@pytest.fixture()
def story(ctx, spark):
    ds = publish(ctx, _frame(spark, [(i, "ab"[i % 2], "v") for i in range(8)] + [(1, "b", "v")]), "c", "changes", partition_by="p")["dataset_id"]
    rep = lambda rows, where: replace_partition(ctx, _frame(spark, rows), ds, where)
    add = lambda rows: publish(ctx, _frame(spark, rows), "c", "changes", dataset_id=ds, mode="append")
    steps = [
        lambda: add([(20, "a", "w"), (1, "b", "v")]),
        lambda: rep([(0, "a", "v"), (2, "a", "new")], "p = 'a'"),
        lambda: merge_rows(ctx, _frame(spark, [(1, "b", "m"), (3, "b", "v"), (50, "c", "m")]), ds, "k"),
        lambda: compact_dataset(ctx, ds),
        lambda: add([(60, "c", "x")]),
        lambda: rep([(60, "c", "y")], "v = 'y' or v = 'x'"),
        lambda: compact_dataset(ctx, ds, files=1),
        lambda: rename_column(ctx, ds, "v", "w"),
        lambda: publish(ctx, _frame(spark, [(1, "b", "m"), (99, "z", "o")], "k long, p string, w string"), "c", "changes", dataset_id=ds, partition_by="p"),
    ]
    for step in steps:
        out = step()
        assert out["accepted"], out
    return ds


def test_every_pair_of_versions(ctx, story):
    last = dataset_state(ctx, story).version
    assert last == 10
    for a, b in [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (1, 5), (5, 7), (1, 8), (7, 8), (8, 9), (3, 9), (9, 10), (1, 10), (0, 10), (10, 10)]:
        _check(ctx, story, a, b)
    assert read_changes(ctx, story, 4, 5).isEmpty() and read_changes(ctx, story, 8, 9).isEmpty()


def test_appends_are_not_compared(ctx, spark, story):
    plan = read_changes(ctx, story, 1, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_dropped_columns_and_recreated_datasets(ctx, spark):
    ds = publish(ctx, _frame(spark, [(1, "a", "x"), (2, "a", "y")]), "c", "d")["dataset_id"]
    drop_column(ctx, ds, "v")
    assert read_changes(ctx, ds, 1).isEmpty()
    delete_dataset(ctx, ds)
    out = publish(ctx, _frame(spark, [(5, "n")], "k long, other string"), "c", "d", dataset_id=ds)
    assert out["accepted"]
    got = read_changes(ctx, ds, 3)
    assert _rows(got) == Counter([(5, "n", "added")])


def test_arguments(ctx, spark, story):
    with pytest.raises(ValueError):
        read_changes(ctx, story, -1)
    with pytest.raises(ValueError):
        read_changes(ctx, story, 9, 3)
    with pytest.raises(ValueError):
        read_changes(ctx, story, 1, change_column="k")


def _folders(ctx, ds):
    return fsys.size_of(ctx.spark, ctx.dataset_root(ds))


def test_expire_keeps_what_kept_versions_read(ctx, spark, story):
    want = {v: _rows(read_dataset(ctx, story, version=v)) for v in range(1, 11)}
    size = _folders(ctx, story)
    plan = expire_versions(ctx, story, keep=4, dry_run=True)  # versions 7 to 10
    assert plan["oldest"] == 7 and plan["bytes"] > 0 and _folders(ctx, story) == size
    out = expire_versions(ctx, story, keep=4)
    assert out["accepted"] and out["n_commits"] == plan["n_commits"] > 0 and out["version"] == 11
    assert _folders(ctx, story)[1] == size[1] - out["bytes"]
    for v in range(7, 11):
        assert _rows(read_dataset(ctx, story, version=v)) == want[v]
    assert _rows(read_dataset(ctx, story)) == want[10]
    for v in range(1, 7):
        with pytest.raises(VersionExpiredError):
            read_dataset(ctx, story, version=v)
    with pytest.raises(VersionExpiredError):
        read_changes(ctx, story, 3, 10)
    _check(ctx, story, 7, 10)
    again = expire_versions(ctx, story, keep=100)
    assert again["n_commits"] == 0 and again["oldest"] == 7
    assert expire_versions(ctx, story, keep=1)["oldest"] == 11
    assert _rows(read_dataset(ctx, story)) == want[10]


def test_expire_by_time_and_carried_commits(ctx, spark):
    ds = publish(ctx, _frame(spark, [(1, "a", "x")]), "c", "d")["dataset_id"]

    def meanwhile(**_):
        ctx.hooks.clear()
        publish(ctx, _frame(spark, [(2, "a", "y")]), "c", "d", dataset_id=ds, mode="append")

    ctx.hooks["register"] = meanwhile
    assert compact_dataset(ctx, ds)["version"] == 3
    between = datetime.now(timezone.utc)
    publish(ctx, _frame(spark, [(3, "a", "z")]), "c", "d", dataset_id=ds, mode="append")
    out = expire_versions(ctx, ds, as_of=between)
    assert out["oldest"] == 3 and out["n_commits"] == 1
    assert read_dataset(ctx, ds, version=3).count() == 2 and read_dataset(ctx, ds).count() == 3
    with pytest.raises(ValueError):
        expire_versions(ctx, ds)
    with pytest.raises(ValueError):
        expire_versions(ctx, ds, keep=0)
