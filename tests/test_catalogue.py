"""Catalogue views, search, listing, sweep, lineage, compaction, streaming."""

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from quire import (
    catalogue_datasets,
    compact_dataset,
    datasets,
    exists_report,
    history,
    lineage_closure,
    lineage_edges,
    partition_counts,
    publish,
    publish_many,
    publish_stream,
    read_dataset,
    schema_violations,
    register_schema,
    schemas,
    search,
    sweep_orphans,
    tags,
)
from quire.sources import filesystem as fsys


def names(df, col="name"):
    return sorted(r[col] for r in df.collect())


def test_tags_and_search(ctx, tables):
    publish(ctx, tables("orders"), "orders", "customer orders", tags={"domain": ["sales"], "tier": ["gold", "pii"]})
    publish(ctx, tables("nation"), "nation", "nations", tags={"domain": "geo"})
    publish(ctx, tables("region"), "region", "World regions")
    assert sorted((r["tag_key"], r["tag_value"]) for r in tags(ctx).filter("name = 'orders'").collect()) == [
        ("domain", "sales"), ("tier", "gold"), ("tier", "pii")
    ]
    assert names(search(ctx, tags={"domain": "sales"})) == ["orders"]
    assert names(search(ctx, tags={"domain": ["sales", "geo"]})) == ["nation", "orders"]
    assert names(search(ctx, without={"domain": "sales"})) == ["nation", "region"]
    assert names(search(ctx, text="REGIONS")) == ["region"]
    assert names(search(ctx, text="100%")) == []
    assert names(search(ctx, tags={"tier": "pii"}, text="orders")) == ["orders"]


def test_schemas_and_violations(ctx, tables, spark):
    publish(ctx, tables("region"), "region", "r")
    got = sorted(
        (r["ordinal"], r["column_name"], r["data_type"])
        for r in datasets(ctx).join(schemas(ctx), "schema_id").collect()
    )
    assert got == [(1, "r_regionkey", "int"), (2, "r_name", "string")]
    sid = register_schema(ctx, "n_nationkey bigint, n_name string, n_comment string")
    frame = tables("nation").withColumn("n_nationkey", F.col("n_nationkey").cast("string"))
    frame = frame.withColumn("n_nationkey", F.when(F.col("n_nationkey") == "7", "seven").otherwise(F.col("n_nationkey")))
    v = sorted(tuple(r) for r in schema_violations(ctx, frame, sid).collect())
    assert v == [
        ("n_comment", "missing", "string", None, None),
        ("n_nationkey", "type", "bigint", "string", 1),
        ("n_regionkey", "extra", None, "int", 25),
    ]
    # a widening is not a violation
    assert schema_violations(ctx, tables("nation").select("n_nationkey", "n_name"), sid).filter("problem = 'type'").count() == 0


def test_exists_report(ctx, tables):
    pub = publish(ctx, tables("nation"), "nation", "n")
    raw = f"{ctx.base}/raw/region"
    tables("region").write.parquet(raw)
    empty = f"{ctx.base}/emptydir"
    fsys.mkdirs(ctx.spark, empty)
    paths = [ctx.dataset_root(pub["dataset_id"]), ctx.processed_dir(pub["dataset_id"]), raw, empty, f"{ctx.base}/nope"]
    rep = {r["path"]: r for r in exists_report(ctx, paths).collect()}
    assert [(rep[p]["has_files"], rep[p]["is_dataset"]) for p in paths] == [
        (True, True), (True, True), (True, False), (False, False), (False, False)
    ]
    assert rep[empty]["exists"] and not rep[f"{ctx.base}/nope"]["exists"]
    one_file = [r["path"] for r in ctx.spark.read.format("binaryFile").load(raw).select("path").collect()][0]
    single = exists_report(ctx, [one_file]).collect()[0]
    assert single["has_files"] and single["n_files"] == 1 and not single["is_dataset"]
    assert rep[raw]["n_files"] >= 1 and rep[raw]["bytes"] > 0


def test_sweep_orphans(ctx, tables):
    kept = publish(ctx, tables("nation"), "nation", "n")["dataset_id"]

    def die(**_):
        raise ConnectionError("driver lost")

    lost = {}
    for step in ("register", "write"):
        ctx.hooks = {step: die, "rollback": die}
        lost[step] = publish(ctx, tables("region"), "r", "r")
    # an attempt under way in a live dataset
    ctx.hooks = {"register": die, "rollback": die}
    appended = publish(ctx, tables("nation"), "n", "n", dataset_id=kept, mode="append")
    ctx.hooks = {}
    # a cutoff in the past protects fresh folders
    assert sweep_orphans(ctx, older_than=timedelta(hours=1)).count() == 0
    dry = {r["commit_id"]: r for r in sweep_orphans(ctx, older_than=timedelta(seconds=-60)).collect()}
    assert set(dry) == {lost["register"]["commit_id"], lost["write"]["commit_id"], appended["commit_id"]}
    assert dry[lost["register"]["commit_id"]]["has_files"] and not dry[lost["write"]["commit_id"]]["has_files"]
    assert dry[lost["register"]["commit_id"]]["bytes"] > 0 and not any(r["deleted"] for r in dry.values())
    assert all(r["deleted"] for r in sweep_orphans(ctx, older_than=timedelta(seconds=-60), dry_run=False).collect())
    assert not any(fsys.exists(ctx.spark, r["folder"]) for r in dry.values())
    assert sweep_orphans(ctx, older_than=timedelta(seconds=-60)).count() == 0
    assert catalogue_datasets(ctx).count() == 1 and read_dataset(ctx, kept).count() == 25


def test_sweep_finishes_a_deletion(ctx, tables, monkeypatch):
    from quire import delete_dataset
    from quire.operators import publish as pub

    ds = publish(ctx, tables("region"), "r", "r")["dataset_id"]
    monkeypatch.setattr(pub, "remove_before", lambda *a: False)
    assert not delete_dataset(ctx, ds)["folder_removed"] and fsys.exists(ctx.spark, ctx.dataset_root(ds))
    assert sweep_orphans(ctx, older_than=timedelta(seconds=-60), dry_run=False).first()["deleted"]
    assert not fsys.exists(ctx.spark, ctx.dataset_root(ds))


def test_partition_counts(ctx, tables):
    ds = publish(ctx, tables("orders"), "orders", "o", partition_by="o_orderstatus")["dataset_id"]
    got = {r["o_orderstatus"]: r["n_rows"] for r in partition_counts(ctx, ds).collect()}
    want = {r["o_orderstatus"]: r["count"] for r in tables("orders").groupBy("o_orderstatus").count().collect()}
    assert got == want


def test_lineage(ctx, tables):
    c = publish(ctx, tables("customer"), "customer", "c")["dataset_id"]
    n = publish(ctx, tables("nation"), "nation", "n")["dataset_id"]
    j = read_dataset(ctx, c).join(read_dataset(ctx, n), F.col("c_nationkey") == F.col("n_nationkey"))
    publish(ctx, j, "joined", "j")
    assert sorted((r["input_name"], r["output_name"]) for r in lineage_edges(ctx).collect()) == [
        ("customer", "joined"), ("nation", "joined")
    ]
    up = sorted((r["dataset_name"], r["distance"]) for r in lineage_closure(ctx, c, "down").collect())
    assert up == [("joined", 1)]


def test_lineage_closure_with_cycle(ctx, spark):
    df = spark.createDataFrame([(1,)], ["x"])
    ids = {k: publish(ctx, df, k, k, inputs=[])["dataset_id"] for k in "abcdxy"}
    for i, o in [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")]:
        publish(ctx, df, o, o, dataset_id=ids[o], mode="append", inputs=[ids[i]])
    down = sorted((r["dataset_name"], r["distance"]) for r in lineage_closure(ctx, ids["a"]).collect())
    assert down == [("b", 1), ("c", 2), ("d", 3)]
    up = sorted((r["dataset_name"], r["distance"]) for r in lineage_closure(ctx, ids["d"], "up").collect())
    assert up == [("a", 3), ("b", 2), ("c", 1)]


def test_publish_many(ctx, tables):
    nation = tables("nation")
    raising = nation.withColumn("n_name", F.when(F.col("n_nationkey") == 20, F.raise_error(F.lit("x"))).otherwise(F.col("n_name")))
    specs = [
        {"df": tables("region"), "name": "region", "description": "r"},
        {"df": nation, "name": "", "description": "no name"},
        {"df": nation, "name": "nation", "description": "d", "tags": "domain=geo"},
        {"df": raising, "name": "nation", "description": "raises"},
        {"df": nation, "name": "nation", "description": "n"},
    ]
    out = [(r["spec_no"], r["accepted"], r["error_type"]) for r in publish_many(ctx, specs).orderBy("spec_no").collect()]
    assert out == [(1, True, None), (2, False, "TypeError"), (3, False, "TypeError"), (4, False, "PublishError"), (5, True, None)]
    assert sorted(r["dataset_name"] for r in catalogue_datasets(ctx).collect()) == ["nation", "region"]


def test_compaction(ctx, tables):
    part = tables("part")
    ds = publish(ctx, part.filter("p_size < 20"), "part", "p")["dataset_id"]
    publish(ctx, part.filter("NOT (p_size < 20)"), "part", "p", dataset_id=ds, mode="append")
    out = compact_dataset(ctx, ds, files=1)
    assert out["accepted"] and out["n_rows"] == part.count()
    assert read_dataset(ctx, ds).exceptAll(part).count() == 0
    assert [(r["mode"], r["live"]) for r in history(ctx, ds).orderBy("version").collect()] == [
        ("overwrite", False), ("append", False), ("compact", True)]
    publish(ctx, part.limit(3), "part", "p", dataset_id=ds, mode="append")
    assert read_dataset(ctx, ds).count() == part.count() + 3
    assert read_dataset(ctx, ds, version=1).count() == part.filter("p_size < 20").count()
    assert catalogue_datasets(ctx).collect()[0]["n_rows"] == part.count() + 3


def test_compaction_beside_other_commits(ctx, spark):
    df = spark.createDataFrame([(1,)], ["x"])
    ds = publish(ctx, df, "n", "d")["dataset_id"]

    def during(mode):
        def hook(**_):
            ctx.hooks.clear()
            assert publish(ctx, df, "n", "d", dataset_id=ds, mode=mode)["accepted"]
        return hook

    ctx.hooks["register"] = during("append")
    assert compact_dataset(ctx, ds)["accepted"]
    assert read_dataset(ctx, ds).count() == 2
    publish(ctx, df, "n", "d", dataset_id=ds, mode="append")
    assert read_dataset(ctx, ds).count() == 3 and catalogue_datasets(ctx).first()["n_rows"] == 3
    assert [r["live"] for r in history(ctx, ds).orderBy("version").collect()] == [False, True, True, True]
    ctx.hooks["register"] = during("overwrite")
    assert compact_dataset(ctx, ds)["error_type"] == "PublishError"
    assert read_dataset(ctx, ds).count() == 1


def test_long_histories(ctx, spark):
    """20,000 replacements and 100,000 appends, each dataset's log as one file of many rows."""
    from quire.sources.catalogue_log import encode, entry_path

    for n, mode in ((20_000, "replace"), (100_000, "append")):
        ds = str(uuid.uuid4())
        rows = [{"dataset_id": ds, "version": v, "reset_version": 1, "mode": "overwrite" if v == 1 else mode,
                 "commit_id": f"c{v}", "data_folder": f"c{v}.a", "n_rows": 1, "total_rows": v} for v in range(1, n + 1)]
        assert fsys.create_new(spark, entry_path(ctx, ds, n), encode(rows))
        h = history(ctx, ds)
        got = h.selectExpr("count(*)", "count(distinct version)", "max(version)", "sum(cast(live as int))").first()
        assert tuple(got) == (n, n, n, n)
        assert h.filter("concat('c', version) <> commit_id").count() == 0


def test_stream_commits_once_per_batch(ctx, spark, tables):
    ev = tables("events")
    src = f"{ctx.base}/stream-src"
    ev.filter("ts < '2024-01-16'").write.parquet(f"{src}/a")
    sdf = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(src)
    ds = str(uuid.uuid4())
    ck = f"{ctx.base}/_streams/ev"
    publish_stream(ctx, sdf, ds, ck, "events", "stream").awaitTermination()
    n1 = read_dataset(ctx, ds).count()
    ev.filter("NOT (ts < '2024-01-16')").write.parquet(f"{src}/b")
    publish_stream(ctx, sdf, ds, ck, "events", "stream").awaitTermination()
    assert read_dataset(ctx, ds).count() == ev.count() > n1
    # replaying a batch with its commit id writes nothing
    from quire.streaming.publish_stream import batch_commit_id

    again = publish(ctx, ev, "events", "stream", dataset_id=ds, mode="append", commit_id=batch_commit_id(ck, 0))
    assert again.get("replayed")
    assert read_dataset(ctx, ds).count() == ev.count()


def test_publish_many_same_dataset_in_order(ctx, spark, tables):
    ds = str(uuid.uuid4())
    region, nation = tables("region"), tables("nation")
    specs = [
        {"df": region, "name": "r", "description": "d", "dataset_id": ds},
        {"df": nation, "name": "n", "description": "d"},
        {"df": region, "name": "r", "description": "d", "dataset_id": ds, "mode": "append"},
        {"df": region, "name": "r", "description": "d", "dataset_id": ds, "mode": "error"},
        {"df": region, "name": "r", "description": "d", "dataset_id": ds, "mode": "ignore"},
    ]
    out = {r["spec_no"]: r for r in publish_many(ctx, specs).collect()}
    assert [out[i]["accepted"] for i in range(1, 6)] == [True, True, True, False, False]
    assert out[4]["error_type"] == "DatasetExistsError" and out[5]["status"] == "ignored"
    assert read_dataset(ctx, ds).count() == 2 * region.count()
    assert sorted(r["dataset_name"] for r in catalogue_datasets(ctx).collect()) == ["n", "r"]


def test_publish_many_waves():
    from quire.operators.publish import _waves

    a, b = str(uuid.uuid4()), str(uuid.uuid4())
    specs = [
        {"dataset_id": a, "mode": "append"},
        {"dataset_id": a, "mode": "append"},
        {"dataset_id": b, "mode": "append"},
        {"dataset_id": a, "mode": "overwrite"},
        {"dataset_id": a, "mode": "append"},
        {"name": "new"},
        {"dataset_id": b, "mode": "append", "mergeSchema": True},
    ]
    # a is live before the batch, b is not
    assert _waves(specs, {a}) == [[1, 2, 3, 6], [4, 7], [5]]


def test_compaction_without_shuffle_keeps_partitions(ctx, tables):
    orders = tables("orders")
    urgent = "coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false)"
    ds = publish(ctx, orders.filter(urgent), "orders", "o", partition_by="o_orderstatus")["dataset_id"]
    publish(ctx, orders.filter(f"NOT {urgent}"), "orders", "o", dataset_id=ds, mode="append")
    out = compact_dataset(ctx, ds)  # files=None: no shuffle
    assert out["accepted"] and out["n_rows"] == orders.count()
    back = read_dataset(ctx, ds)
    assert back.exceptAll(orders).count() == 0 and orders.exceptAll(back).count() == 0
    got = {r["o_orderstatus"]: r["n_rows"] for r in partition_counts(ctx, ds).collect()}
    want = {r["o_orderstatus"]: r["count"] for r in orders.groupBy("o_orderstatus").count().collect()}
    assert got == want


def test_partition_counts_unpartitioned(ctx, tables):
    ds = publish(ctx, tables("region"), "region", "r")["dataset_id"]
    rows = partition_counts(ctx, ds).collect()
    assert len(rows) == 1 and rows[0]["n_rows"] == 5 and rows[0]["n_files"] >= 1


def test_lineage_closure_depth_limit(ctx, spark):
    df = spark.createDataFrame([(1,)], ["x"])
    ids = {k: publish(ctx, df, k, k, inputs=[])["dataset_id"] for k in "abcd"}
    for i, o in [("a", "b"), ("b", "c"), ("c", "d")]:
        publish(ctx, df, o, o, dataset_id=ids[o], mode="append", inputs=[ids[i]])
    near = sorted((r["dataset_name"], r["distance"]) for r in lineage_closure(ctx, ids["a"], max_depth=2).collect())
    assert near == [("b", 1), ("c", 2)]
