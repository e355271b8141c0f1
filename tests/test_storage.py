"""Path-level storage API: write modes, read, probes, delete."""

import uuid

import pytest

from quire import PathStorage


@pytest.fixture()
def store(spark):
    return PathStorage(spark)


@pytest.fixture()
def folder(ctx):
    return f"{ctx.base}/plain/{uuid.uuid4().hex}"


def test_write_read_modes(store, spark, folder):
    df = spark.createDataFrame([("Alice", 30), ("Bob", 40)], ["name", "age"])
    store.write(df, folder)
    assert store.read(folder).count() == 2
    store.append(spark.createDataFrame([("Charlie", 35)], ["name", "age"]), folder)
    assert store.read(folder).count() == 3
    with pytest.raises(RuntimeError, match="Failed to write data to storage at"):
        store.write(df, folder, mode="error")
    store.write(df, folder, mode="ignore")
    assert store.read(folder).count() == 3
    store.write(df, folder, mode="overwrite")
    assert store.read(folder).count() == 2


def test_write_checks(store, spark, folder):
    df = spark.createDataFrame([(1,)], ["x"])
    with pytest.raises(ValueError):
        store.write(df, folder, mode="upsert")
    with pytest.raises(TypeError):
        store.write(df, "")
    with pytest.raises(TypeError):
        store.write("not a frame", folder)


def test_partitioned_write_and_options(store, spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2)], ["k", "v"])
    store.write(df, folder, partition_by="k", compression="zstd", unused=None)
    assert sorted(r["k"] for r in store.read(folder).collect()) == ["a", "b"]


def test_read_errors(store, folder):
    with pytest.raises(TypeError):
        store.read("")
    with pytest.raises(RuntimeError, match="Failed to read data from"):
        store.read(folder + "/absent")


def test_probes_and_delete(store, spark, folder):
    assert not store.check_path_exists(folder)
    assert not store.file_exists(folder)
    store.write(spark.createDataFrame([], "x int"), folder)
    assert store.check_path_exists(folder)  # an empty table counts
    assert store.file_exists(folder)
    store.delete(folder)
    assert not store.file_exists(folder)
    store.delete(folder)  # missing: no-op
    with pytest.raises(ValueError):
        store.delete("")


def test_a_failure_to_look_raises(store):
    with pytest.raises(Exception, match="nosuchscheme"):
        store.check_path_exists("nosuchscheme://host/path")


def test_foreign_files_and_delete_forms(store, spark, folder):
    spark.range(3).write.parquet(folder)
    assert store.check_path_exists(folder) and store.read(folder).count() == 3
    with pytest.raises(RuntimeError, match="another program"):
        store.append(spark.range(2), folder)
    assert store.write(spark.range(2), folder, mode="ignore")["status"] == "ignored"
    with pytest.raises(RuntimeError, match="Failed to delete"):
        store.delete(folder, recursive=False)
    assert store.delete(folder, recursive=True) and not store.delete(folder, recursive=True)


def test_append_is_checked_and_overwrite_keeps_readers(store, spark, folder):
    store.write(spark.createDataFrame([(1,)], "x int"), folder)
    with pytest.raises(RuntimeError, match="Failed to write data"):
        store.append(spark.createDataFrame([("a",)], "x string"), folder)
    before = store.read(folder)
    store.write(spark.createDataFrame([(2,)], "x int"), folder)
    assert before.collect()[0][0] == 1 and store.read(folder).collect()[0][0] == 2


def test_active_session_is_used(spark, folder):
    assert PathStorage().spark is spark
