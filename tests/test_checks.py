"""Argument checks raise; they never write anything."""

import uuid

import pytest

from quire import publish
from quire.functions import checks


def test_save_happy_path_returns_ids(ctx, spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], ["letter", "number"])
    out = publish(ctx, df, "letters", "letters and numbers", tags={"domain": ["sales"]})
    assert out["accepted"] and out["n_rows"] == 3
    uuid.UUID(out["dataset_id"])
    uuid.UUID(out["commit_id"])


def test_not_a_dataframe(ctx):
    with pytest.raises(TypeError):
        publish(ctx, "a string", "name", "description")


@pytest.mark.parametrize("name", ["", None, 4.5, b"orders"])
def test_bad_name(ctx, spark, name):
    df = spark.createDataFrame([("nut", 4)], ["part", "size"])
    with pytest.raises(TypeError):
        publish(ctx, df, name, "parts")


def test_bad_description(ctx, spark):
    df = spark.createDataFrame([("nut", 4)], ["part", "size"])
    with pytest.raises(TypeError):
        publish(ctx, df, "name", None)


def test_empty_description_is_fine(ctx, spark):
    df = spark.createDataFrame([("nut", 4)], ["part", "size"])
    assert publish(ctx, df, "name", "")["accepted"]


@pytest.mark.parametrize("tags", ["domain=geo", [("domain", "geo")], 7])
def test_bad_tags(ctx, spark, tags):
    df = spark.createDataFrame([("nut", 4)], ["part", "size"])
    with pytest.raises(TypeError):
        publish(ctx, df, "name", "description", tags=tags)


@pytest.mark.parametrize("dataset_id", ["", 0, "orders", b"x"])
def test_bad_dataset_id(ctx, spark, dataset_id):
    df = spark.createDataFrame([("nut", 4)], ["part", "size"])
    with pytest.raises(TypeError):
        publish(ctx, df, "name", "description", dataset_id=dataset_id)


def test_uuid_object_and_string_ids_accepted():
    u = uuid.uuid4()
    assert checks.check_dataset_id(u) == str(u)
    assert checks.check_dataset_id(str(u).upper()) == str(u)


def test_bad_mode(ctx, spark):
    df = spark.createDataFrame([("nut", 4)], ["part", "size"])
    with pytest.raises(ValueError):
        publish(ctx, df, "name", "description", mode="merge")


def test_append_needs_dataset_id(ctx, spark):
    df = spark.createDataFrame([("nut", 4)], ["part", "size"])
    with pytest.raises(ValueError):
        publish(ctx, df, "name", "description", mode="append")


def test_reserved_and_case_equal_columns(ctx, spark):
    with pytest.raises(ValueError):
        publish(ctx, spark.createDataFrame([(1,)], ["commit_id"]), "n", "d")
    with pytest.raises(ValueError):
        publish(ctx, spark.createDataFrame([(1, 2)], ["Ab", "aB"]), "n", "d")


def test_partition_checks(ctx, spark):
    df = spark.createDataFrame([("a", 1)], ["k", "v"])
    with pytest.raises(ValueError):
        publish(ctx, df, "n", "d", partition_by="nope")
    with pytest.raises(ValueError):
        publish(ctx, df, "n", "d", partition_by=["k", "v"])
    with pytest.raises(TypeError):
        publish(ctx, df, "n", "d", partition_by=5)


def test_none_options_are_dropped():
    assert checks.clean_options({"compression": "zstd", "x": None, "flag": True}) == {
        "compression": "zstd",
        "flag": "true",
    }


def test_tag_normalisation():
    assert checks.normalise_tags({"a": "b", "c": ["d", "e"], 1: 2}) == {
        "a": ["b"], "c": ["d", "e"], "1": ["2"]
    }


@pytest.mark.parametrize("cid", ["", "a/b", "k=v", "_hidden", ".dot", "x%20", 7])
def test_bad_commit_ids(cid):
    with pytest.raises(TypeError):
        checks.check_commit_id(cid)


def test_good_commit_ids():
    assert checks.check_commit_id("batch-7.v2_x") == "batch-7.v2_x"


def test_streaming_frame_refused(ctx, spark, tables):
    sdf = spark.readStream.schema(tables("region").schema).parquet("/root/testdata/sf0.001/region*.parquet")
    with pytest.raises(TypeError, match="publish_stream"):
        publish(ctx, sdf, "r", "d")


def test_catalogue_save_one_call(spark):
    from quire import Catalogue

    cat = Catalogue(spark)
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], ["letter", "number"])
    out = cat.save(df, "Dataset Name", "Description", tags={"environment": ["test"]})
    assert out["accepted"] and out["n_rows"] == 3
    assert cat.read(out["dataset_id"]).count() == 3
    assert [r["dataset_name"] for r in cat.datasets().collect()] == ["Dataset Name"]
    assert cat.search(tags={"environment": "test"}).count() == 1
    with pytest.raises(TypeError):
        cat.save("a string", "name", "description")
