"""One function per catalogue operator, run over the fixture tables.

Each takes ``(spark, sf_dir)``, publishes whole fixture tables into a fresh
catalogue in the shared checkpoint folder (it must outlive the call: the result
is lazy, T19) and returns a DataFrame. ``ORACLE_SQL`` holds the same answer as
SQL over the plain tables.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.context import Context
from quire.functions.catalogue import catalogue_datasets, datasets, history, schemas, search, tags
from quire.functions.schemas import register_schema, schema_violations
from quire.operators.maintain import compact_dataset, partition_counts, sweep_orphans
from quire.operators.publish import delete_dataset, publish, publish_many, replace_partition
from quire.plans.lineage import lineage_closure, lineage_edges
from quire.sources.catalogue_log import read_log
from quire.sources.datasets import read_dataset
from quire.sources.listing import exists_report, files_under
from quire.sources.storage import PathStorage
from quire.streaming.publish_stream import publish_stream

# Fixed values of the fixtures: the split instant of `events` and the segment
# replaced in W9.
EVENTS_SPLIT = "2024-01-16 00:00:00"
SEGMENT = "BUILDING"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ctx(spark: SparkSession, label: str) -> Context:
    return Context.scratch(spark, label)


def _ok(out: dict) -> dict:
    if not out.get("accepted"):
        raise RuntimeError(f"publish failed: {out}")
    return out


def _split(df: DataFrame, cond: F.Column) -> tuple[DataFrame, DataFrame]:
    """A predicate and its exact complement (nulls go to the second part)."""
    c = F.coalesce(cond, F.lit(False))
    return df.filter(c), df.filter(~c)


def publish_roundtrip(spark, sf_dir):
    ctx = _ctx(spark, "w1")
    out = _ok(publish(ctx, _table(spark, sf_dir, "lineitem"), "lineitem", "TPC-H line items"))
    return read_dataset(ctx, out["dataset_id"])


def publish_overwrite(spark, sf_dir):
    ctx = _ctx(spark, "w2")
    cust = _table(spark, sf_dir, "customer")
    first = _ok(publish(ctx, cust, "customer", "all customers"))
    _ok(publish(ctx, cust.filter(F.col("c_mktsegment") == SEGMENT), "customer", "one segment",
                dataset_id=first["dataset_id"], mode="overwrite"))
    return read_dataset(ctx, first["dataset_id"])


def _events_in_two(spark, sf_dir, ctx):
    ev = _table(spark, sf_dir, "events")
    early, late = _split(ev, F.col("ts") < F.lit(EVENTS_SPLIT).cast("timestamp_ntz"))
    first = _ok(publish(ctx, early, "events", "click stream"))
    _ok(publish(ctx, late, "events", "click stream", dataset_id=first["dataset_id"], mode="append"))
    return first["dataset_id"]


def publish_append(spark, sf_dir):
    ctx = _ctx(spark, "w3")
    return read_dataset(ctx, _events_in_two(spark, sf_dir, ctx))


def publish_error_if_exists(spark, sf_dir):
    ctx = _ctx(spark, "w4")
    nation = _table(spark, sf_dir, "nation")
    first = _ok(publish(ctx, nation, "nation", "nations"))
    again = publish(ctx, nation, "nation", "nations", dataset_id=first["dataset_id"], mode="error")
    return read_dataset(ctx, first["dataset_id"]).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("nation").alias("dataset_name"),
        F.lit(bool(again["accepted"])).alias("accepted"),
        F.lit(again.get("error_type")).cast("string").alias("error_type"),
        "n_rows",
    )


def publish_ignore_if_exists(spark, sf_dir):
    ctx = _ctx(spark, "w5")
    first = _ok(publish(ctx, _table(spark, sf_dir, "nation"), "nation", "nations"))
    out = publish(ctx, _table(spark, sf_dir, "region"), "nation", "nations",
                  dataset_id=first["dataset_id"], mode="ignore")
    assert out["status"] == "ignored", out
    return read_dataset(ctx, first["dataset_id"])


def publish_partitioned(spark, sf_dir):
    ctx = _ctx(spark, "w6")
    out = _ok(publish(ctx, _table(spark, sf_dir, "orders"), "orders", "orders by status",
                      partition_by=["o_orderstatus", "o_orderpriority"]))
    return read_dataset(ctx, out["dataset_id"])


def partition_counts_query(spark, sf_dir):
    ctx = _ctx(spark, "w7")
    out = _ok(publish(ctx, _table(spark, sf_dir, "orders"), "orders", "orders", partition_by="o_orderstatus"))
    return partition_counts(ctx, out["dataset_id"]).select("o_orderstatus", "n_rows")


def append_new_column(spark, sf_dir):
    ctx = _ctx(spark, "w8")
    sup = _table(spark, sf_dir, "supplier")
    old, new = _split(sup, F.col("s_suppkey") < 50)
    first = _ok(publish(ctx, old.drop("s_acctbal"), "supplier", "suppliers"))
    _ok(publish(ctx, new, "supplier", "suppliers", dataset_id=first["dataset_id"], mode="append", mergeSchema=True))
    return read_dataset(ctx, first["dataset_id"])


def replace_partition_query(spark, sf_dir):
    ctx = _ctx(spark, "w9")
    cust = _table(spark, sf_dir, "customer")
    first = _ok(publish(ctx, cust, "customer", "customers", partition_by="c_mktsegment"))
    fresh = cust.filter(F.col("c_mktsegment") == SEGMENT).withColumn("c_acctbal", F.lit(0.0))
    _ok(replace_partition(ctx, fresh, first["dataset_id"], f"c_mktsegment = '{SEGMENT}'"))
    return read_dataset(ctx, first["dataset_id"])


def read_version(spark, sf_dir):
    ctx = _ctx(spark, "w10")
    return read_dataset(ctx, _events_in_two(spark, sf_dir, ctx), version=1)


def exists_report_query(spark, sf_dir):
    ctx = _ctx(spark, "w11")
    pub = _ok(publish(ctx, _table(spark, sf_dir, "nation"), "nation", "nations"))
    raw = f"{ctx.base}/raw/region"
    _table(spark, sf_dir, "region").write.mode("errorifexists").parquet(raw)
    missing = f"{ctx.base}/missing/{uuid.uuid4().hex}"
    kinds = {ctx.dataset_root(pub["dataset_id"]): "published", raw: "raw", missing: "missing"}
    rep = exists_report(ctx, list(kinds))
    label = F.lit(None).cast("string")
    for p, k in kinds.items():
        label = F.when(F.col("path") == p, F.lit(k)).otherwise(label)
    return rep.select(label.alias("path_kind"), "has_files", "is_dataset")


def delete_dataset_query(spark, sf_dir):
    ctx = _ctx(spark, "w12")
    reg = _ok(publish(ctx, _table(spark, sf_dir, "region"), "region", "regions"))
    _ok(publish(ctx, _table(spark, sf_dir, "nation"), "nation", "nations"))
    out = delete_dataset(ctx, reg["dataset_id"])
    assert out["accepted"], out
    return catalogue_datasets(ctx).select("dataset_name", "n_rows")


def rollback_failed_publish(spark, sf_dir):
    """A publish that fails at registering, while another one commits to the same new
    dataset: what is left is the other's commit and data, nothing of the first."""
    ctx = _ctx(spark, "w13")
    region, ds = _table(spark, sf_dir, "region"), str(uuid.uuid4())

    def refuse(**_):
        ctx.hooks.clear()
        _ok(publish(ctx, region, "region", "regions", dataset_id=ds))
        raise ConnectionError("catalogue unreachable")

    ctx.hooks["register"] = refuse
    out = publish(ctx, region, "region", "regions", dataset_id=ds)
    own = f"commit_id={out['commit_id']}"
    files = files_under(ctx, [ctx.dataset_root(ds)]).filter(F.col("path").contains(own))
    log = read_log(ctx).filter(F.col("dataset_id") == ds)
    both = files.select(F.lit(1).alias("f"), F.lit(0).alias("c"), F.lit(0).alias("r")).unionByName(
        log.select(F.lit(0).alias("f"), (F.col("commit_id") == out["commit_id"]).cast("int").alias("c"), F.lit(0).alias("r"))
    ).unionByName(read_dataset(ctx, ds).select(F.lit(0).alias("f"), F.lit(0).alias("c"), F.lit(1).alias("r")))
    return both.agg(
        F.coalesce(F.sum("f"), F.lit(0)).cast("bigint").alias("files_left"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("catalogue_rows_left"),
        F.sum("r").cast("bigint").alias("rows_of_the_other"),
    ).select(
        F.lit("region").alias("dataset_name"),
        F.lit(out["error_type"]).alias("error_type"),
        "files_left",
        "catalogue_rows_left",
        "rows_of_the_other",
    )


def catalogue_datasets_query(spark, sf_dir):
    ctx = _ctx(spark, "w14")
    for name in ("nation", "region", "orders"):
        _ok(publish(ctx, _table(spark, sf_dir, name), name, f"{name} table"))
    return catalogue_datasets(ctx).select("dataset_name", "n_rows")


def sweep_orphans_query(spark, sf_dir):
    """Two publishers that die: one after its data was written, one before. The rows of
    the dataset that did commit are counted beside what the sweep takes."""
    ctx = _ctx(spark, "w15")
    ds = _ok(publish(ctx, _table(spark, sf_dir, "nation"), "nation", "nations"))["dataset_id"]

    def die(**_):
        raise ConnectionError("driver lost")

    commits = {}
    for step, label in (("register", "stray1"), ("write", "stray2")):
        ctx.hooks = {step: die, "rollback": die}
        commits[publish(ctx, _table(spark, sf_dir, "region"), "region", "regions")["commit_id"]] = label
    ctx.hooks = {}
    swept = sweep_orphans(ctx, older_than=timedelta(seconds=-60), dry_run=False)
    label = F.create_map(*[F.lit(x) for kv in commits.items() for x in kv])[F.col("commit_id")]
    kept = read_dataset(ctx, ds).agg(F.count(F.lit(1)).alias("n_rows"))
    return swept.select(label.alias("folder"), "has_files", F.lit(None).cast("bigint").alias("n_rows")).unionByName(
        kept.select(F.lit("kept").alias("folder"), F.lit(True).alias("has_files"), "n_rows")
    )


def _tagged_catalogue(spark, sf_dir, label):
    ctx = _ctx(spark, label)
    _ok(publish(ctx, _table(spark, sf_dir, "orders"), "orders", "customer orders",
                tags={"domain": ["sales"], "tier": ["gold", "pii"]}))
    _ok(publish(ctx, _table(spark, sf_dir, "nation"), "nation", "nations", tags={"domain": "geo"}))
    _ok(publish(ctx, _table(spark, sf_dir, "region"), "region", "World regions", tags={}))
    return ctx


def catalogue_tags(spark, sf_dir):
    ctx = _tagged_catalogue(spark, sf_dir, "w16")
    return tags(ctx).select(F.col("name").alias("dataset_name"), "tag_key", "tag_value")


def search_datasets(spark, sf_dir):
    ctx = _tagged_catalogue(spark, sf_dir, "w17")
    found = [
        ("domain=sales", search(ctx, tags={"domain": "sales"})),
        ("tier=pii", search(ctx, tags={"tier": "pii"})),
        ("not domain=sales", search(ctx, without={"domain": "sales"})),
        ("text=regions", search(ctx, text="regions")),
    ]
    out = None
    for label, df in found:
        part = df.select(F.lit(label).alias("search"), F.col("name").alias("dataset_name"))
        out = part if out is None else out.unionByName(part)
    return out


def schema_inferred(spark, sf_dir):
    ctx = _ctx(spark, "w18")
    for name in ("nation", "region"):
        _ok(publish(ctx, _table(spark, sf_dir, name), name, f"{name} table"))
    return (
        datasets(ctx)
        .join(schemas(ctx), "schema_id")
        .select(F.col("name").alias("dataset_name"), "ordinal", "column_name", "data_type")
    )


def schema_conform(spark, sf_dir):
    """Published and appended to under one schema id; reads have its columns and types."""
    ctx = _ctx(spark, "w19")
    sid = register_schema(ctx, "n_name string, n_regionkey bigint, n_nationkey int")
    low, high = _split(_table(spark, sf_dir, "nation"), F.col("n_nationkey") < 12)
    out = _ok(publish(ctx, low, "nation", "nations", schema_id=sid))
    more = _ok(publish(ctx, high, "nation", "nations", schema_id=sid, dataset_id=out["dataset_id"], mode="append"))
    assert more["schema_id"] == out["schema_id"] == sid, more
    return read_dataset(ctx, out["dataset_id"])


def schema_violations_query(spark, sf_dir):
    """A published dataset against a registered schema: columns that do not fit and their values in the way."""
    ctx = _ctx(spark, "w20")
    sid = register_schema(ctx, "c_custkey bigint, c_name string, c_acctbal int, c_comment string, c_nationkey int")
    key = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("n"), F.col("c_nationkey"))).otherwise(F.col("c_nationkey").cast("string"))
    out = _ok(publish(ctx, _table(spark, sf_dir, "customer").withColumn("c_nationkey", key), "customer", "customers"))
    return schema_violations(ctx, read_dataset(ctx, out["dataset_id"]), sid)


def publish_many_query(spark, sf_dir):
    ctx = _ctx(spark, "w21")
    nation = _table(spark, sf_dir, "nation")
    raising = nation.withColumn(
        "n_name",
        F.when(F.col("n_nationkey") == 20, F.raise_error(F.lit("source failed midway")))
        .otherwise(F.col("n_name")),
    )
    specs = [
        {"df": _table(spark, sf_dir, "region"), "name": "region", "description": "regions"},
        {"df": nation, "name": "", "description": "no name"},
        {"df": nation, "name": "nation", "description": "bad tags", "tags": "domain=geo"},
        {"df": raising, "name": "nation", "description": "raises midway"},
        {"df": nation, "name": "nation", "description": "nations"},
    ]
    return publish_many(ctx, specs).select("spec_no", "accepted", "error_type")


def _lineage(spark, sf_dir, label):
    """customer and nation -> by_nation -> summary; summary's earlier source was overwritten."""
    ctx = _ctx(spark, label)
    c = _ok(publish(ctx, _table(spark, sf_dir, "customer"), "customer", "customers"))["dataset_id"]
    n = _ok(publish(ctx, _table(spark, sf_dir, "nation"), "nation", "nations"))["dataset_id"]
    joined = read_dataset(ctx, c).join(read_dataset(ctx, n), F.col("c_nationkey") == F.col("n_nationkey"))
    j = _ok(publish(ctx, joined, "by_nation", "customers with their nation"))["dataset_id"]
    old = _ok(publish(ctx, read_dataset(ctx, n).select("n_name"), "summary", "names"))["dataset_id"]
    counts = read_dataset(ctx, j).groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"))
    _ok(publish(ctx, counts, "summary", "customers per nation", dataset_id=old))
    return ctx, old


def lineage_edges_query(spark, sf_dir):
    ctx, _ = _lineage(spark, sf_dir, "w22")
    return lineage_edges(ctx).select("input_name", "output_name")


def lineage_upstream(spark, sf_dir):
    """All sources of a dataset with their distance and row counts."""
    ctx, ds = _lineage(spark, sf_dir, "w22u")
    rows = catalogue_datasets(ctx).select("dataset_id", "n_rows")
    return lineage_closure(ctx, ds, "up").join(rows, "dataset_id").select("dataset_name", "distance", "n_rows")


def lineage_closure_query(spark, sf_dir):
    ctx = _ctx(spark, "w23")
    src = {"a": "region", "b": "nation", "c": "customer", "x": "supplier", "y": "part"}
    ids = {}
    for name in ("a", "b", "c", "x", "y"):
        ids[name] = _ok(publish(ctx, _table(spark, sf_dir, src[name]), name, f"{src[name]} as {name}", inputs=[]))["dataset_id"]
    declared = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")]
    for i, o in declared:
        _ok(publish(ctx, read_dataset(ctx, ids[o]), o, f"{src[o]} as {o}", dataset_id=ids[o],
                    mode="overwrite", inputs=[ids[i]]))
    return lineage_closure(ctx, ids["a"], "down").select("dataset_name", "distance")


def publish_stream_query(spark, sf_dir):
    """Two files, one a micro-batch: the first commit creates the dataset, the second appends."""
    ctx = _ctx(spark, "x1")
    events = _table(spark, sf_dir, "events")
    early, late = _split(events, F.col("ts") < F.lit(EVENTS_SPLIT).cast("timestamp_ntz"))
    source = f"{ctx.base}/_source"
    for part in (early, late):
        part.coalesce(1).write.mode("append").parquet(source)
    sdf = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    ds = str(uuid.uuid4())
    q = publish_stream(ctx, sdf, ds, f"{ctx.base}/_streams/events", "events", "event stream")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    assert history(ctx, ds).count() == 2
    return read_dataset(ctx, ds)


def _in_pieces(spark, sf_dir, ctx):
    """``part`` as four commits of one dataset."""
    rest, ds = _table(spark, sf_dir, "part"), None
    for bound in (10, 25, 40, None):
        piece, rest = _split(rest, F.col("p_size") < bound) if bound else (rest, None)
        ds = _ok(publish(ctx, piece, "part", "parts", dataset_id=ds, mode="append" if ds else "overwrite"))["dataset_id"]
    return ds


def compact_dataset_query(spark, sf_dir):
    ctx = _ctx(spark, "x2")
    ds = _in_pieces(spark, sf_dir, ctx)
    _ok(compact_dataset(ctx, ds))
    return read_dataset(ctx, ds)


def compact_during_append(spark, sf_dir):
    """Rows appended while a compaction is under way stay."""
    ctx = _ctx(spark, "x3")
    ds = _in_pieces(spark, sf_dir, ctx)

    def meanwhile(**_):
        ctx.hooks.clear()
        _ok(publish(ctx, _table(spark, sf_dir, "part").filter("p_size >= 40"), "part", "parts", dataset_id=ds, mode="append"))

    ctx.hooks["register"] = meanwhile
    _ok(compact_dataset(ctx, ds))
    return read_dataset(ctx, ds)


def history_query(spark, sf_dir):
    """Versions of a dataset with rows, totals and what is live."""
    ctx = _ctx(spark, "h1")
    ds = _events_in_two(spark, sf_dir, ctx)
    _ok(publish(ctx, _table(spark, sf_dir, "region"), "events", "regions now", dataset_id=ds))
    return history(ctx, ds).select(F.col("version").cast("int").alias("version"), "mode", "n_rows", "total_rows", "live")


def append_replayed(spark, sf_dir):
    """An append that is repeated under its commit id counts once; the same id on another
    dataset is another commit."""
    ctx = _ctx(spark, "h2")
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    ids = {n: _ok(publish(ctx, df, n, n))["dataset_id"] for n, df in (("nation", nation), ("region", region))}
    for _ in range(2):
        for n, df in (("nation", nation), ("region", region)):
            _ok(publish(ctx, df, n, n, dataset_id=ids[n], mode="append", commit_id="day-1"))
    return catalogue_datasets(ctx).select("dataset_name", "n_rows")


def read_as_of(spark, sf_dir):
    ctx = _ctx(spark, "h3")
    ds = _events_in_two(spark, sf_dir, ctx)
    noon = datetime.now(timezone.utc)
    _ok(publish(ctx, _table(spark, sf_dir, "events").limit(0), "events", "emptied", dataset_id=ds))
    return read_dataset(ctx, ds, as_of=noon)


def dynamic_overwrite(spark, sf_dir):
    """A slice replaced through writer options, partitioned by a timestamp."""
    ctx = _ctx(spark, "s9")
    day = F.to_timestamp(F.date_trunc("day", F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")))
    ev = _table(spark, sf_dir, "events").withColumn("day", day)
    ds = _ok(publish(ctx, ev, "events", "by day", partition_by="day"))["dataset_id"]
    late = ev.filter(F.col("ts") >= F.lit(EVENTS_SPLIT).cast("timestamp_ntz")).withColumn("value", F.lit(0.0))
    _ok(publish(ctx, late, "events", "by day", dataset_id=ds, mode="overwrite", partitionOverwriteMode="dynamic"))
    return read_dataset(ctx, ds).drop("day")


def path_write_append_read(spark, sf_dir):
    """A table at a path: written, appended to, checked, read."""
    store, path = PathStorage(spark), f"{Context.scratch(spark, 'path').base}/orders"
    orders = _table(spark, sf_dir, "orders")
    early, late = _split(orders, F.col("o_orderkey") % 3 == 0)
    assert not store.check_path_exists(path)
    store.write(early, path, partition_by="o_orderstatus")
    store.append(late, path)
    assert store.check_path_exists(path)
    return store.read(path)


QUERIES = {
    "publish_roundtrip": publish_roundtrip,
    "publish_overwrite": publish_overwrite,
    "publish_append": publish_append,
    "publish_error_if_exists": publish_error_if_exists,
    "publish_ignore_if_exists": publish_ignore_if_exists,
    "publish_partitioned": publish_partitioned,
    "partition_counts": partition_counts_query,
    "append_new_column": append_new_column,
    "replace_partition": replace_partition_query,
    "read_version": read_version,
    "exists_report": exists_report_query,
    "delete_dataset": delete_dataset_query,
    "rollback_failed_publish": rollback_failed_publish,
    "catalogue_datasets": catalogue_datasets_query,
    "sweep_orphans": sweep_orphans_query,
    "catalogue_tags": catalogue_tags,
    "search_datasets": search_datasets,
    "schema_inferred": schema_inferred,
    "schema_conform": schema_conform,
    "schema_violations": schema_violations_query,
    "publish_many": publish_many_query,
    "lineage_edges": lineage_edges_query,
    "lineage_closure": lineage_closure_query,
    "publish_stream": publish_stream_query,
    "compact_dataset": compact_dataset_query,
    "compact_during_append": compact_during_append,
    "history": history_query,
    "append_replayed": append_replayed,
    "read_as_of": read_as_of,
    "dynamic_overwrite": dynamic_overwrite,
    "lineage_upstream": lineage_upstream,
    "path_write_append_read": path_write_append_read,
}

ORACLE_SQL = {
    "publish_roundtrip": "SELECT * FROM lineitem",
    "publish_overwrite": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "publish_append": "SELECT * FROM events",
    "publish_error_if_exists": (
        "SELECT 'nation' AS dataset_name, FALSE AS accepted, 'DatasetExistsError' AS error_type, "
        "count(*) AS n_rows FROM nation"
    ),
    "publish_ignore_if_exists": "SELECT * FROM nation",
    "publish_partitioned": "SELECT * FROM orders",
    "partition_counts": "SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY o_orderstatus",
    "append_new_column": (
        "SELECT s_suppkey, s_name, s_nationkey, "
        "CASE WHEN s_suppkey >= 50 THEN s_acctbal END AS s_acctbal FROM supplier"
    ),
    "replace_partition": (
        "SELECT c_custkey, c_name, c_nationkey, "
        "CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(0 AS DOUBLE) ELSE c_acctbal END AS c_acctbal, "
        "c_mktsegment FROM customer"
    ),
    "read_version": "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'",
    "exists_report": (
        "SELECT * FROM (VALUES ('published',TRUE,TRUE), ('raw',TRUE,FALSE), ('missing',FALSE,FALSE)) "
        "t(path_kind, has_files, is_dataset)"
    ),
    "delete_dataset": "SELECT 'nation' AS dataset_name, count(*) AS n_rows FROM nation",
    "rollback_failed_publish": (
        "SELECT 'region' AS dataset_name, 'RegistrationError' AS error_type, CAST(0 AS BIGINT) AS files_left, "
        "CAST(0 AS BIGINT) AS catalogue_rows_left, count(*) AS rows_of_the_other FROM region"
    ),
    "catalogue_datasets": (
        "SELECT 'nation' AS dataset_name, count(*) AS n_rows FROM nation UNION ALL "
        "SELECT 'region', count(*) FROM region UNION ALL SELECT 'orders', count(*) FROM orders"
    ),
    "sweep_orphans": (
        "SELECT * FROM (VALUES ('stray1',TRUE,NULL::BIGINT), ('stray2',FALSE,NULL)) t(folder, has_files, n_rows) "
        "UNION ALL SELECT 'kept', TRUE, count(*) FROM nation"
    ),
    "catalogue_tags": (
        "SELECT * FROM (VALUES ('orders','domain','sales'), ('orders','tier','gold'), "
        "('orders','tier','pii'), ('nation','domain','geo')) t(dataset_name, tag_key, tag_value)"
    ),
    "search_datasets": (
        "SELECT * FROM (VALUES ('domain=sales','orders'), ('tier=pii','orders'), "
        "('not domain=sales','nation'), ('not domain=sales','region'), ('text=regions','region')) "
        "t(search, dataset_name)"
    ),
    "schema_inferred": (
        "SELECT * FROM (VALUES ('nation',1,'n_nationkey','int'), ('nation',2,'n_name','string'), "
        "('nation',3,'n_regionkey','int'), ('region',1,'r_regionkey','int'), ('region',2,'r_name','string')) "
        "t(dataset_name, ordinal, column_name, data_type)"
    ),
    "schema_conform": "SELECT n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey, n_nationkey FROM nation",
    "schema_violations": (
        "SELECT 'c_comment' AS column_name, 'missing' AS problem, 'string' AS expected_type, "
        "NULL::VARCHAR AS actual_type, NULL::BIGINT AS n_values "
        "UNION ALL SELECT 'c_mktsegment', 'extra', NULL, 'string', count(c_mktsegment) FROM customer "
        "UNION ALL SELECT 'c_acctbal', 'type', 'int', 'double', "
        "count(*) FILTER (abs(c_acctbal) >= 2147483648) FROM customer "
        "UNION ALL SELECT 'c_nationkey', 'type', 'int', 'string', count(*) FILTER (c_nationkey % 2 = 0) FROM customer"
    ),
    "publish_many": (
        "SELECT * FROM (VALUES (1,TRUE,NULL), (2,FALSE,'TypeError'), (3,FALSE,'TypeError'), "
        "(4,FALSE,'PublishError'), (5,TRUE,NULL)) t(spec_no, accepted, error_type)"
    ),
    "lineage_edges": (
        "SELECT * FROM (VALUES ('customer','by_nation'), ('nation','by_nation'), ('by_nation','summary')) "
        "t(input_name, output_name)"
    ),
    "lineage_closure": "SELECT * FROM (VALUES ('b',1), ('c',2)) t(dataset_name, distance)",
    "publish_stream": "SELECT * FROM events",
    "compact_dataset": "SELECT * FROM part",
    "compact_during_append": "SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_size >= 40",
    "history": (
        "WITH e AS (SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-16 00:00:00') AS a, count(*) AS n FROM events) "
        "SELECT 1 AS version, 'overwrite' AS mode, a AS n_rows, a AS total_rows, FALSE AS live FROM e "
        "UNION ALL SELECT 2, 'append', n - a, n, FALSE FROM e "
        "UNION ALL SELECT 3, 'overwrite', count(*), count(*), TRUE FROM region"
    ),
    "append_replayed": (
        "SELECT 'nation' AS dataset_name, 2 * count(*) AS n_rows FROM nation "
        "UNION ALL SELECT 'region', 2 * count(*) FROM region"
    ),
    "read_as_of": "SELECT * FROM events",
    "dynamic_overwrite": (
        "SELECT * REPLACE (CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN CAST(0 AS DOUBLE) ELSE value END AS value) "
        "FROM events"
    ),
    "lineage_upstream": (
        "SELECT 'by_nation' AS dataset_name, 1 AS distance, count(*) AS n_rows "
        "FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "UNION ALL SELECT 'customer', 2, count(*) FROM customer UNION ALL SELECT 'nation', 2, count(*) FROM nation"
    ),
    "path_write_append_read": "SELECT * FROM orders",
}
