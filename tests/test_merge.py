"""Merges by key: update, insert, delete, and what they do to reads, versions and other commits."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire import compact_dataset, merge_rows, publish, read_dataset, replace_partition
from quire.sources import datasets as dsmod


def _rows(df):
    return Counter(map(tuple, df.collect()))


def _frame(spark, rows, schema="k long, part string, v string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def made(ctx, spark):
    df = _frame(spark, [(i, "ab"[i % 2], f"v{i}") for i in range(40)]).repartition(4)
    out = publish(ctx, df, "m", "merge", partition_by="part")
    assert out["accepted"], out
    return out["dataset_id"]


def _plain(n=40):
    return {(i, "ab"[i % 2], f"v{i}"): 1 for i in range(n)}


def test_update_insert_delete(ctx, spark, made):
    src = _frame(spark, [(1, "b", "new", False), (2, "a", "x", True), (100, "c", "more", False), (200, "c", "no", True), (3, "a", "moved", None)],
                 "k long, part string, v string, del boolean")
    out = merge_rows(ctx, src, made, "k", delete_where="del")
    assert out["accepted"] and out["mode"] == "merge" and out["n_rows"] == 3
    want = Counter(_plain())
    for k in (1, 2, 3):
        del want[(k, "ab"[k % 2], f"v{k}")]
    want |= Counter([(1, "b", "new"), (100, "c", "more"), (3, "a", "moved")])
    assert _rows(read_dataset(ctx, made)) == want
    assert _rows(read_dataset(ctx, made, version=1)) == Counter(_plain())
    assert dsmod.dataset_state(ctx, made).total_rows == sum(want.values())


def test_old_files_stay_as_they_are(ctx, spark, made):
    data = lambda: {f for f in read_dataset(ctx, made).inputFiles() if "/Processed/" in f}
    before = data()
    merge_rows(ctx, _frame(spark, [(1, "b", "new")]), made, "k")
    after = data()
    assert before < after and len(after - before) == 1


def test_two_rows_of_one_key_are_refused(ctx, spark, made):
    for rows, where in (([(1, "a", "x"), (1, "a", "y")], None), ([(1, "a", "x"), (1, "a", "gone")], "v = 'gone'")):
        out = merge_rows(ctx, _frame(spark, rows), made, ["k"], delete_where=where)
        assert not out["accepted"] and "one key" in out["error"], out
    assert _rows(read_dataset(ctx, made)) == Counter(_plain())
    assert dsmod.dataset_state(ctx, made).version == 1


def test_null_keys_match_nothing(ctx, spark, made):
    null = _frame(spark, [(None, "a", "n1"), (None, "a", "n2")])
    assert merge_rows(ctx, null, made, "k")["accepted"]
    assert merge_rows(ctx, null, made, ["k", "part"])["accepted"]
    assert read_dataset(ctx, made).filter("k is null").count() == 4


def test_repeated_old_rows_become_one(ctx, spark, made):
    publish(ctx, _frame(spark, [(1, "b", "again")] * 3), "m", "merge", dataset_id=made, mode="append")
    merge_rows(ctx, _frame(spark, [(1, "b", "one")]), made, "k")
    assert [tuple(r) for r in read_dataset(ctx, made).filter("k = 1").collect()] == [(1, "b", "one")]


def test_several_merges_then_other_commits(ctx, spark, made):
    want = Counter(_plain())
    for n in range(3):
        merge_rows(ctx, _frame(spark, [(n, "ab"[n % 2], f"m{n}"), (5, "b", f"five{n}")]), made, "k")
        for r in [r for r in want if r[0] in (n, 5)]:
            del want[r]
        want |= Counter([(n, "ab"[n % 2], f"m{n}"), (5, "b", f"five{n}")])
        assert _rows(read_dataset(ctx, made)) == want
    assert replace_partition(ctx, _frame(spark, [(0, "a", "slice")]), made, "part = 'a'")["accepted"]
    want = Counter({r: n for r, n in want.items() if r[1] != "a"}) + Counter([(0, "a", "slice")])
    assert _rows(read_dataset(ctx, made)) == want
    merge_rows(ctx, _frame(spark, [(0, "a", "after")]), made, "k")
    want = want - Counter([(0, "a", "slice")]) + Counter([(0, "a", "after")])
    assert _rows(read_dataset(ctx, made)) == want
    assert compact_dataset(ctx, made)["accepted"]
    assert _rows(read_dataset(ctx, made)) == want
    st = dsmod.dataset_state(ctx, made)
    assert len(st.live) == 1 and not st.live[0].hidden and st.total_rows == sum(want.values())


def test_a_row_appended_meanwhile_is_merged_too(ctx, spark, made):
    def other(**_):
        ctx.hooks.clear()
        publish(ctx, _frame(spark, [(1, "b", "late"), (77, "b", "late")]), "m", "merge", dataset_id=made, mode="append")

    ctx.hooks["register"] = other
    out = merge_rows(ctx, _frame(spark, [(1, "b", "mine"), (77, "b", "mine")]), made, "k")
    assert out["accepted"] and out["version"] == 3
    assert _rows(read_dataset(ctx, made).filter("k in (1, 77)")) == Counter([(1, "b", "mine"), (77, "b", "mine")])


def test_many_hidden_rows_only_shuffle_the_files_that_hold_them(ctx, spark, made, monkeypatch):
    src = _frame(spark, [(i, "a", f"x{i}") for i in range(0, 10, 2)])
    merge_rows(ctx, src, made, "k")
    want = _rows(read_dataset(ctx, made))
    monkeypatch.setattr(dsmod, "BROADCAST_ROWS", 2)
    assert _rows(read_dataset(ctx, made)) == want
    monkeypatch.setattr(dsmod, "_FILES", 0)
    assert _rows(read_dataset(ctx, made)) == want


def test_bad_arguments(ctx, spark, made):
    df = _frame(spark, [(1, "a", "x")])
    with pytest.raises(TypeError):
        merge_rows(ctx, df, made, [])
    with pytest.raises(ValueError):
        merge_rows(ctx, df, made, "nope")
    with pytest.raises(ValueError):
        merge_rows(ctx, df.withColumn("v", F.rand().cast("string")), made, "k")
    assert merge_rows(ctx, df.drop("v"), made, "k")["error_type"] == "SchemaMismatchError"
    assert merge_rows(ctx, df.withColumn("extra", F.lit(1)), made, "k")["error_type"] == "SchemaMismatchError"
    again = merge_rows(ctx, df, made, "k", commit_id="0f4b6a0e-51c5-4f53-8a3a-6f6a6d1f9b99")
    assert merge_rows(ctx, df, made, "k", commit_id="0f4b6a0e-51c5-4f53-8a3a-6f6a6d1f9b99")["replayed"] and again["version"] == 2


def _shuffles_above_scan(df, column):
    """Shuffles of the final plan that rows of the scan with this column go through."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = text.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*(0123456789)")) for x in lines]
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and f"{column}#" in x]
    assert len(scans) == 1 and "isFinalPlan=true" in text, text
    above, at = [], depth[scans[0]]
    for i in range(scans[0] - 1, -1, -1):
        if depth[i] < at:
            at = depth[i]
            above.append(lines[i])
    return [x for x in above if "Exchange" in x and "BroadcastExchange" not in x]


@pytest.mark.parametrize("n", [1, 50])
def test_reads_after_replacements_do_not_shuffle_data(ctx, spark, n):
    df = _frame(spark, [(i, "abc"[i % 3], f"v{i}") for i in range(30)], "_version long, _gone string, _gone_value string")
    ds = publish(ctx, df, "m", "names", partition_by="_gone")["dataset_id"]
    for k in range(n):
        out = replace_partition(ctx, _frame(spark, [(k, "a", "new")], "_version long, _gone string, _gone_value string"), ds, "_gone = 'a'")
        assert out["accepted"], out
    got = read_dataset(ctx, ds)
    want = Counter([(i, "abc"[i % 3], f"v{i}") for i in range(30) if i % 3]) + Counter([(n - 1, "a", "new")])
    assert Counter((r["_version"], r["_gone"], r["_gone_value"]) for r in got.collect()) == want
    assert _shuffles_above_scan(got, "_gone_value") == []


def test_any_column_names(ctx, spark):
    names = "k long, _file string, _row long, _version long, _hidden boolean, _hidden_file string, file string, row long, n long, _key long"
    df = spark.createDataFrame([(i, "f", i, i, True, "h", "g", i, i, i) for i in range(10)], names)
    ds = publish(ctx, df, "m", "names")["dataset_id"]
    assert merge_rows(ctx, df.filter("k < 3").withColumn("file", F.lit("new")), ds, "k")["accepted"]
    assert replace_partition(ctx, df.filter("n = 9"), ds, "n = 9")["accepted"]
    got = read_dataset(ctx, ds)
    assert got.columns == df.columns and got.count() == 10 and got.filter("file = 'new'").count() == 3


def test_reads_after_a_merge_do_not_shuffle_data(ctx, spark, made):
    merge_rows(ctx, _frame(spark, [(1, "b", "new")]), made, "k")
    assert _shuffles_above_scan(read_dataset(ctx, made), "v") == []


def test_predicate_replacements_keep_the_plan_small(ctx, spark, monkeypatch):
    from quire.operators import publish as pub

    df = _frame(spark, [(i, "a", f"v{i}") for i in range(20)])
    many = publish(ctx, df, "m", "places")["dataset_id"]
    for k in range(12):
        assert replace_partition(ctx, _frame(spark, [(k, "b", "new")]), many, f"k = {k}")["accepted"]
    want = Counter([(i, "b", "new") if i < 12 else (i, "a", f"v{i}") for i in range(20)])
    got = read_dataset(ctx, many)
    assert _rows(got) == want and dsmod.dataset_state(ctx, many).total_rows == 20
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    monkeypatch.setattr(pub, "BROADCAST_ROWS", 1)
    assert replace_partition(ctx, _frame(spark, [(1, "c", "new")]), many, "part = 'c' or k < 5")["accepted"]
    want = Counter({r: n for r, n in want.items() if r[0] >= 5}) + Counter([(1, "c", "new")])
    assert _rows(read_dataset(ctx, many)) == want
    assert dsmod.dataset_state(ctx, many).live[-1].replace_where and dsmod.dataset_state(ctx, many).total_rows == 16
