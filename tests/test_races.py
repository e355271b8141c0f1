"""Two writers, or a writer and a sweep, at the same dataset: no accepted commit may vanish."""

from collections import Counter
from datetime import timedelta

from pyspark.sql import functions as F

from quire import PathStorage, catalogue_datasets, publish, read_dataset, sweep_orphans
from quire.sources.catalogue_log import entries, last_version
from quire.sources import filesystem as fsys
from quire.sources.datasets import dataset_state

DS = "0f4b6a0e-51c5-4f53-8a3a-6f6a6d1f9b33"


def _rows(df):
    return Counter(map(tuple, df.collect()))


def _frame(spark, rows, kind="a int, b string"):
    return spark.createDataFrame(rows, kind)


def _creating(ctx, df, **kw):
    return publish(ctx, df, "r", "race", dataset_id=DS, mode="append", create=True, **kw)


def _race(ctx, first, second):
    """``second`` commits while ``first`` is about to."""
    outcome = {}

    def other(**_):
        ctx.hooks.clear()
        outcome["second"] = second()

    ctx.hooks["register"] = other
    outcome["first"] = first()
    return outcome


def test_two_creating_appends_keep_both(ctx, spark):
    a, b = _frame(spark, [(1, "x"), (2, "x"), (3, "x")]), _frame(spark, [(9, "y")])
    out = _race(ctx, lambda: _creating(ctx, a), lambda: _creating(ctx, b))
    assert out["first"]["accepted"] and out["second"]["accepted"]
    assert out["first"]["mode"] == "append" and out["first"]["version"] == 2
    assert _rows(read_dataset(ctx, DS)) == Counter([(1, "x"), (2, "x"), (3, "x"), (9, "y")])
    assert dataset_state(ctx, DS).total_rows == 4


def test_a_creating_append_of_another_schema_is_refused(ctx, spark):
    for n, (df, kw) in enumerate([(_frame(spark, [(1,)], "z int"), {}), (_frame(spark, [(1, "x")]), {"partition_by": "b"})]):
        ds = DS[:-1] + str(n)
        put = lambda frame, **k: publish(ctx, frame, "r", "race", dataset_id=ds, mode="append", create=True, **k)  # noqa: E731,B023
        out = _race(ctx, lambda: put(df, **kw), lambda: put(_frame(spark, [(9, "y")])))  # noqa: B023
        assert out["second"]["accepted"] and out["first"]["error_type"] == "SchemaMismatchError"
        assert _rows(read_dataset(ctx, ds)) == Counter([(9, "y")])


def test_a_swept_publish_does_not_commit(ctx, spark):
    """The sweep takes a publish that is still at work: it ends with an error, and nothing is lost."""
    first = publish(ctx, _frame(spark, [(1, "x")]), "r", "race", dataset_id=DS)
    assert first["accepted"]
    out = _race(
        ctx, lambda: publish(ctx, _frame(spark, [(2, "y")]), "r", "race", dataset_id=DS, mode="append"),
        lambda: sweep_orphans(ctx, timedelta(seconds=-60), dry_run=False).collect(),
    )
    assert len(out["second"]) == 1 and out["second"][0]["deleted"]
    assert not out["first"]["accepted"] and "swept" in out["first"]["error"], out["first"]
    assert _rows(read_dataset(ctx, DS)) == Counter([(1, "x")])
    assert publish(ctx, _frame(spark, [(3, "z")]), "r", "race", dataset_id=DS, mode="append")["accepted"]
    assert read_dataset(ctx, DS).count() == 2


def test_a_swept_first_publish_makes_no_dataset(ctx, spark):
    out = _race(ctx, lambda: publish(ctx, _frame(spark, [(2, "y")]), "r", "race", dataset_id=DS),
                lambda: sweep_orphans(ctx, timedelta(seconds=-60), dry_run=False).collect())
    assert not out["first"]["accepted"] and catalogue_datasets(ctx).isEmpty()
    assert publish(ctx, _frame(spark, [(3, "z")]), "r", "race", dataset_id=DS, mode="error")["accepted"]
    assert read_dataset(ctx, DS).count() == 1


def test_a_commit_before_the_fence_keeps_its_data(ctx, spark, monkeypatch):
    """The publish commits between the sweep's look at the log and its fence."""
    from quire.operators import maintain

    real, done = maintain.fence, {}

    def late(c, ds, folders):
        if not done:
            done["out"] = publish(ctx, _frame(spark, [(5, "e")]), "r", "race", dataset_id=DS)
            row = entries(ctx, DS, [1])[0]
            folders.append(row["data_folder"])  # as if the sweep had seen it unfinished
        return real(c, ds, folders)

    def die(**_):
        raise ConnectionError("driver lost")

    ctx.hooks = {"register": die, "rollback": die}
    publish(ctx, _frame(spark, [(4, "d")]), "r", "race", dataset_id=DS)
    ctx.hooks = {}
    monkeypatch.setattr(maintain, "fence", late)
    swept = sweep_orphans(ctx, timedelta(seconds=-60), dry_run=False).collect()
    assert len(swept) == 1 and swept[0]["deleted"] and done["out"]["accepted"]
    assert _rows(read_dataset(ctx, DS)) == Counter([(5, "e")])


def test_a_path_after_a_failed_or_unfinished_write(spark, ctx, tmp_path):
    store, path, df = PathStorage(spark), f"{tmp_path}/t", _frame(spark, [(1, "x")])
    raising = df.withColumn("a", F.raise_error(F.lit("lost")).cast("int"))
    from quire.context import Context
    from quire.operators.publish import prepare, write_commit
    from quire.sources.storage import PATH_DATASET

    at = Context(spark, path)
    at.hooks = {"rollback": lambda **_: (_ for _ in ()).throw(OSError("no"))}
    plan = prepare(at, raising, "t", path, dataset_id=PATH_DATASET, mode="append", create=True)
    assert write_commit(at, plan)["error"]
    plan = prepare(at, df, "t", path, dataset_id=PATH_DATASET, mode="append", create=True)
    assert write_commit(at, plan) is None  # written, not committed: another writer at work
    assert not store.check_path_exists(path)
    assert store.append(df, path)["accepted"]
    assert _rows(store.read(path)) == Counter([(1, "x")]) and store.check_path_exists(path)


def test_overwrite_at_a_path_takes_away_what_was_there(spark, tmp_path):
    store, path = PathStorage(spark), f"{tmp_path}/t"
    _frame(spark, [(1, "x")]).write.parquet(path)
    store.write(_frame(spark, [(7, 8)], "c int, d int"), path)
    assert [r.asDict() for r in store.read(path).collect()] == [{"c": 7, "d": 8}]
    assert [r["c"] for r in spark.read.parquet(path).collect()] == [7]


def test_versions_in_a_path_s_options(spark, tmp_path):
    store, path = PathStorage(spark), f"{tmp_path}/t"
    store.write(_frame(spark, [(1, "x")]), path)
    store.append(_frame(spark, [(2, "y")]), path)
    assert store.read(path, versionAsOf=1).count() == 1 and store.read(path).count() == 2


def test_last_version_from_any_hint(ctx, spark):
    from quire.sources.catalogue_log import encode, entry_path

    for v in range(1, 71):
        assert fsys.create_new(spark, entry_path(ctx, DS, v), encode([{"dataset_id": DS, "version": v}]))
    for hint in (None, b"1", b"16", b"64", b"70", b"99", b"zz", b""):
        if hint is not None:
            fsys.put_bytes(spark, f"{ctx.log_of(DS)}/_at", hint)
        assert last_version(ctx, DS) == 70
