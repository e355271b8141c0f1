"""Queries over the rows, columns and versions of published datasets, and over races between writers."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from quire.functions.catalogue import catalogue_datasets
from quire.functions.profiles import distinct_counts, key_columns, profile
from quire.functions.ranking import ranked_search
from quire.operators.alter import drop_column, rename_column, widen_column
from quire.operators.maintain import compact_dataset, sweep_orphans
from quire.operators.merge import merge_rows
from quire.operators.publish import publish, replace_partition
from quire.operators.retain import expire_versions
from quire.plans.column_lineage import column_lineage
from quire.scenarios import SEGMENT, _ctx, _ok, _split, _table
from quire.sources.changes import read_changes
from quire.sources.datasets import dataset_state, read_dataset
from quire.sources.skipping import files_matching, read_where
from quire.sources.storage import PathStorage
from quire.streaming.read_stream import stream_changes

LATE = "1997-01-01"  # orders from here on come as a second commit
FEW = 40  # percent of the files that a clustered layout may leave to read


def _orders(spark, sf_dir, ctx, **kw):
    """``orders`` as two commits."""
    early, late = _split(_table(spark, sf_dir, "orders"), F.col("o_orderdate") < LATE)
    ds = _ok(publish(ctx, early, "orders", "customer orders", **kw))["dataset_id"]
    _ok(publish(ctx, late, "orders", "customer orders", dataset_id=ds, mode="append"))
    return ds


def merge_rows_query(spark, sf_dir):
    """Orders updated, inserted and deleted by key, twice; a frame with two rows of one key is refused."""
    ctx = _ctx(spark, "m1")
    ds = _orders(spark, sf_dir, ctx, partition_by="o_orderstatus")
    orders = _table(spark, sf_dir, "orders")
    third = orders.filter("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(0.0).cast(orders.schema["o_totalprice"].dataType))
    _ok(merge_rows(ctx, third.withColumn("gone", F.col("o_orderkey") % 2 == 0), ds, "o_orderkey", delete_where="gone"))
    new = orders.filter("o_orderkey % 5 = 0").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    _ok(merge_rows(ctx, new.unionByName(orders.filter("o_orderkey % 9 = 0").withColumn("o_orderstatus", F.lit("Z"))), ds, ["o_orderkey"]))
    assert not merge_rows(ctx, orders.unionByName(orders), ds, "o_orderkey")["accepted"]
    return read_dataset(ctx, ds)


def read_changes_query(spark, sf_dir):
    """Customers: append, a replaced slice, a compaction, an overwrite; all changes since the first commit, by step and in one."""
    ctx = _ctx(spark, "m2")
    cust = _table(spark, sf_dir, "customer")
    low, high = _split(cust, F.col("c_custkey") % 2 == 0)
    ds = _ok(publish(ctx, low, "customer", "customers", partition_by="c_mktsegment"))["dataset_id"]
    _ok(publish(ctx, high, "customer", "customers", dataset_id=ds, mode="append"))
    slice_ = cust.filter(F.col("c_mktsegment") == SEGMENT)
    _ok(replace_partition(ctx, slice_.filter("c_custkey % 3 <> 0"), ds, f"c_mktsegment = '{SEGMENT}'"))
    _ok(compact_dataset(ctx, ds))
    _ok(publish(ctx, cust.filter("c_custkey % 4 <> 0"), "customer", "customers", dataset_id=ds, partition_by="c_mktsegment"))
    out = None
    for a, b in ((1, 2), (2, 3), (3, 4), (4, 5), (1, 5)):
        part = read_changes(ctx, ds, a, b, "kind").groupBy("kind").agg(
            F.count("*").alias("n_rows"), F.sum("c_custkey").alias("keys")).select(F.lit(f"{a}-{b}").alias("versions"), "kind", "n_rows", "keys")
        out = part if out is None else out.unionByName(part)
    return out


def alter_columns(spark, sf_dir):
    """Commits from before and after a rename, a drop, a re-add of the dropped name and a widening."""
    ctx = _ctx(spark, "m3")
    parts = _table(spark, sf_dir, "part").withColumn("p_size", F.col("p_size").cast("int"))
    a, rest = _split(parts, F.col("p_size") < 15)
    b, c = _split(rest, F.col("p_size") < 30)
    ds = _ok(publish(ctx, a, "part", "parts"))["dataset_id"]
    _ok(rename_column(ctx, ds, "p_name", "title"))
    _ok(drop_column(ctx, ds, "p_type"))
    _ok(publish(ctx, b.withColumnRenamed("p_name", "title").drop("p_type"), "part", "parts", dataset_id=ds, mode="append"))
    _ok(widen_column(ctx, ds, "p_size", "bigint"))
    again = c.withColumnRenamed("p_name", "title").withColumn("p_size", F.col("p_size") + F.lit(1 << 40)).withColumn("p_type", F.lit(7))
    _ok(publish(ctx, again, "part", "parts", dataset_id=ds, mode="append", mergeSchema=True))
    return read_dataset(ctx, ds).select("p_partkey", "title", "p_size", "p_type")


def expire_versions_query(spark, sf_dir):
    """Four versions of the suppliers, two kept: which can be read, and with how many rows."""
    ctx = _ctx(spark, "m4")
    sup, ds = _table(spark, sf_dir, "supplier"), None
    for k in range(4):
        ds = _ok(publish(ctx, sup.filter(F.col("s_suppkey") % 4 >= k), "supplier", "suppliers", dataset_id=ds))["dataset_id"]
    out = _ok(expire_versions(ctx, ds, keep=2))
    assert out["n_commits"] == 2 and out["bytes"] > 0, out
    rows = None
    for version in range(1, 5):
        try:
            part = read_dataset(ctx, ds, version=version).agg(F.count("*").alias("n_rows")).withColumn("kept", F.lit(True))
        except Exception as e:  # noqa: BLE001 - its type is the answer
            assert type(e).__name__ == "VersionExpiredError", e
            part = spark.range(1).select(F.lit(None).cast("long").alias("n_rows"), F.lit(False).alias("kept"))
        part = part.select(F.lit(version).alias("version"), "kept", "n_rows")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def read_where_query(spark, sf_dir):
    """Line items of some orders and days, through the files' statistics."""
    ctx = _ctx(spark, "m5")
    lines = _table(spark, sf_dir, "lineitem").repartitionByRange(16, "l_orderkey")
    ds = _ok(publish(ctx, lines, "lineitem", "lines", skip_by=["l_orderkey", "l_quantity", "l_returnflag"]))["dataset_id"]
    low, high = 100, 900
    st = dataset_state(ctx, ds)
    met, every = files_matching(ctx, st, {"l_orderkey": (low, high)}).count(), files_matching(ctx, st, {"l_orderkey": (None, None)}).count()
    assert met < every, (met, every)
    assert files_matching(ctx, st, {"l_returnflag": "BY PIGEON"}).isEmpty()
    return read_where(ctx, ds, {"l_orderkey": (low, high), "l_quantity": (10, None)})


def cluster_dataset(spark, sf_dir):
    """Line items clustered by part and supplier: files that a box of both meets, before and after, and its rows."""
    ctx = _ctx(spark, "m6")
    lines = _table(spark, sf_dir, "lineitem")
    lines = lines.repartition(16, F.xxhash64("l_orderkey", "l_linenumber"))
    ds = _ok(publish(ctx, lines, "lineitem", "lines", skip_by=["l_partkey", "l_suppkey"]))["dataset_id"]
    top = lines.agg(F.max("l_partkey").alias("p"), F.max("l_suppkey").alias("s")).first()
    box = {"l_partkey": (1, top["p"] // 4), "l_suppkey": (1, top["s"] // 4)}
    before = files_matching(ctx, dataset_state(ctx, ds), box).count()
    _ok(compact_dataset(ctx, ds, files=16, cluster_by=["l_partkey", "l_suppkey"]))
    after = files_matching(ctx, dataset_state(ctx, ds), box).count()
    found = read_where(ctx, ds, box).agg(F.count("*").alias("n_rows"))
    return found.select("n_rows", F.lit(100 * after <= FEW * before).alias("few_files"))


def append_create_race(spark, sf_dir):
    """Two writers append to a dataset that neither found there: both parts stay."""
    ctx = _ctx(spark, "m7")
    ds = str(uuid.uuid4())
    low, high = _split(_table(spark, sf_dir, "orders"), F.col("o_orderkey") % 2 == 0)
    add = lambda df: _ok(publish(ctx, df, "orders", "orders", dataset_id=ds, mode="append", create=True))

    def other(**_):
        ctx.hooks.clear()
        add(high)

    ctx.hooks["register"] = other
    add(low)
    return read_dataset(ctx, ds)


def sweep_during_publish(spark, sf_dir):
    """A sweep takes an append that is still at work: the append ends with an error, the dataset stays whole."""
    ctx = _ctx(spark, "m8")
    cust = _table(spark, sf_dir, "customer")
    low, high = _split(cust, F.col("c_custkey") % 2 == 0)
    ds = _ok(publish(ctx, low, "customer", "customers"))["dataset_id"]
    taken = []

    def sweep(**_):
        ctx.hooks.clear()
        taken.extend(sweep_orphans(ctx, timedelta(seconds=-60), dry_run=False).collect())

    ctx.hooks["register"] = sweep
    out = publish(ctx, high, "customer", "customers", dataset_id=ds, mode="append")
    rows = read_dataset(ctx, ds).agg(F.count("*").alias("n_rows"), F.sum("c_custkey").alias("keys"))
    total = catalogue_datasets(ctx).select(F.col("n_rows").alias("total_rows"))
    return rows.crossJoin(F.broadcast(total)).withColumns(  # one row each
        {"accepted": F.lit(bool(out["accepted"])), "swept": F.lit(len(taken))})


def path_after_failed_write(spark, sf_dir):
    """A first write at a path fails and cannot be undone; what it left is nobody's table, and the next write stands."""
    path = f"{_ctx(spark, 'm9').base}/table"
    store, nation = PathStorage(spark), _table(spark, sf_dir, "nation")
    broken = nation.withColumn("n_name", F.when(F.col("n_nationkey") < 20, F.col("n_name")).otherwise(F.raise_error(F.lit("lost"))))
    try:
        store.write(broken, path, mode="append")
    except RuntimeError:
        pass
    assert not store.check_path_exists(path)
    store.append(nation, path)
    return store.read(path)


def stream_changes_query(spark, sf_dir):
    """A copy of the orders kept by a stream of their changes, over commits of all kinds and a restart."""
    ctx = _ctx(spark, "m10")
    ds, copy = _orders(spark, sf_dir, ctx), str(uuid.uuid4())
    orders = _table(spark, sf_dir, "orders")

    def sink(changes, _low, _high, batch):
        _ok(publish(ctx, changes, "copy", "changes of the orders", dataset_id=copy, mode="append", create=True, commit_id=f"batch-{batch}"))

    def follow():
        q = stream_changes(ctx, ds, f"{ctx.base}/_streams/copy", sink)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    follow()
    free = orders.filter("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(0.0).cast(orders.schema["o_totalprice"].dataType))
    _ok(merge_rows(ctx, free, ds, "o_orderkey"))
    _ok(compact_dataset(ctx, ds))
    _ok(replace_partition(ctx, orders.filter("o_orderkey % 10 = 1").limit(0), ds, "o_orderkey % 10 = 1"))
    follow()
    names = orders.columns
    sign = F.when(F.col("_change") == "added", 1).otherwise(-1)
    net = read_dataset(ctx, copy).groupBy(*names).agg(F.sum(sign).alias("n")).filter("n > 0")
    return net.select(*names, F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int"))).alias("each")).drop("each")


def ranked_search_query(spark, sf_dir):
    """A dataset for each market segment, described by its nations: scores for the words of some nations' names."""
    ctx = _ctx(spark, "m11")
    cust, nation = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation")
    named = cust.filter("c_custkey % 7 = 0").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    about = named.groupBy("c_mktsegment").agg(F.concat_ws(" ", F.sort_array(F.collect_list("n_name"))).alias("text"))
    for r in about.collect():  # a dataset each; there are five segments
        part = cust.filter(F.col("c_mktsegment") == r["c_mktsegment"]).select("c_custkey", "c_name")
        _ok(publish(ctx, part, r["c_mktsegment"], r["text"], tags={"kind": ["segment"]}))
    words = " ".join(r[0] for r in nation.filter("n_nationkey < 4").select("n_name").collect())
    found = ranked_search(ctx, f"{words} segment custkey")
    return found.select(F.col("name").alias("segment"), F.round("score", 6).alias("score"))


def column_lineage_query(spark, sf_dir):
    """Where the columns of a joined and aggregated frame come from, with the rows of each source."""
    ctx = _ctx(spark, "m12")
    ids = {n: _ok(publish(ctx, _table(spark, sf_dir, n), n, n))["dataset_id"] for n in ("customer", "orders")}
    cust, orders = (read_dataset(ctx, ids[n]) for n in ("customer", "orders"))
    frame = cust.join(orders, F.col("c_custkey") == F.col("o_custkey")).groupBy("c_mktsegment").agg(
        F.sum(F.col("o_totalprice") - F.col("c_acctbal")).alias("net"), F.max("o_orderdate").alias("last"))
    edges = column_lineage(ctx, frame)
    sizes = catalogue_datasets(ctx).select(F.col("dataset_id").alias("input_dataset_id"), "dataset_name", "n_rows")
    return edges.join(sizes, "input_dataset_id").select("column_name", "dataset_name", "input_column", "how", "n_rows")


def profile_dataset(spark, sf_dir):
    """Line items in three commits, profiled from their sketches: counts, whether estimates keep their bounds, keys."""
    ctx = _ctx(spark, "m13")
    lines, ds = _table(spark, sf_dir, "lineitem").withColumn("id", F.concat_ws("-", "l_orderkey", "l_linenumber", F.monotonically_increasing_id())), None
    lines = lines.withColumn("l_tax", F.when(F.col("l_quantity") > 5, F.col("l_tax")))
    for k in range(3):
        ds = _ok(publish(ctx, lines.filter(F.col("l_orderkey") % 3 == k), "lineitem", "lines", dataset_id=ds, mode="append" if ds else "overwrite"))["dataset_id"]
    exact = distinct_counts(ctx, ds)
    keys = key_columns(ctx, ds)
    out = profile(ctx, ds).join(exact, "column_name")
    near = F.abs(F.col("n_distinct") - F.col("n")) <= F.greatest(0.05 * F.col("n"), F.lit(1))
    return out.select("column_name", "n_rows", "n_nulls", near.alias("near"), F.col("column_name").isin(keys).alias("is_key"))


QUERIES = {
    "stream_changes": stream_changes_query,
    "ranked_search": ranked_search_query,
    "column_lineage": column_lineage_query,
    "profile_dataset": profile_dataset,
    "merge_rows": merge_rows_query,
    "read_changes": read_changes_query,
    "alter_columns": alter_columns,
    "expire_versions": expire_versions_query,
    "read_where": read_where_query,
    "cluster_dataset": cluster_dataset,
    "append_create_race": append_create_race,
    "sweep_during_publish": sweep_during_publish,
    "path_after_failed_write": path_after_failed_write,
}

_CHANGED = f"""
WITH v1 AS (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0), v2 AS (SELECT c_custkey FROM customer),
v3 AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> '{SEGMENT}' OR c_custkey % 3 <> 0),
v5 AS (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0),
c AS (
  SELECT '1-2' AS versions, 'added' AS kind, c_custkey FROM (FROM v2 EXCEPT ALL FROM v1) UNION ALL
  SELECT '2-3', 'removed', c_custkey FROM (FROM v2 EXCEPT ALL FROM v3) UNION ALL
  SELECT '4-5', 'added', c_custkey FROM (FROM v5 EXCEPT ALL FROM v3) UNION ALL
  SELECT '4-5', 'removed', c_custkey FROM (FROM v3 EXCEPT ALL FROM v5) UNION ALL
  SELECT '1-5', 'added', c_custkey FROM (FROM v5 EXCEPT ALL FROM v1) UNION ALL
  SELECT '1-5', 'removed', c_custkey FROM (FROM v1 EXCEPT ALL FROM v5))
SELECT versions, kind, count(*) AS n_rows, sum(c_custkey)::BIGINT AS keys FROM c GROUP BY versions, kind"""

_RANKED = r"""
WITH about AS (SELECT c_mktsegment AS segment, string_agg(n_name, ' ') AS text FROM customer JOIN nation ON c_nationkey = n_nationkey
               WHERE c_custkey % 7 = 0 GROUP BY c_mktsegment),
docs AS (SELECT segment, regexp_extract_all(lower(segment || ' ' || text || ' kind segment c_custkey c_name'), '[\p{L}\p{N}]+') AS terms FROM about),
sizes AS (SELECT count(*) AS n, avg(len(terms)) AS mean FROM docs),
tf AS (SELECT segment, len(terms) AS length, term, count(*) AS tf FROM (SELECT segment, terms, unnest(terms) AS term FROM docs) GROUP BY ALL),
words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(string_agg(n_name, ' ') || ' segment custkey'), '[\p{L}\p{N}]+')) AS term
          FROM nation WHERE n_nationkey < 4),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT segment, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score
FROM tf JOIN words USING (term) JOIN df USING (term), sizes GROUP BY segment"""

ORACLE_SQL = {
    "stream_changes": (
        "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_totalprice END AS o_totalprice) FROM orders WHERE o_orderkey % 10 <> 1"
    ),
    "ranked_search": _RANKED,
    "column_lineage": (
        "WITH c AS (SELECT count(*) AS n FROM customer), o AS (SELECT count(*) AS n FROM orders) "
        "SELECT 'c_mktsegment' AS column_name, 'customer' AS dataset_name, 'c_mktsegment' AS input_column, 'direct' AS how, n AS n_rows FROM c "
        "UNION ALL SELECT 'net', 'customer', 'c_acctbal', 'derived', n FROM c UNION ALL SELECT 'net', 'orders', 'o_totalprice', 'derived', n FROM o "
        "UNION ALL SELECT 'last', 'orders', 'o_orderdate', 'derived', n FROM o"
    ),
    "profile_dataset": (
        "SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', "
        "'l_returnflag', 'l_linestatus', 'l_shipdate', 'id']) AS column_name, count(*) AS n_rows, "
        "unnest([0, 0, 0, 0, 0, 0, 0, count(*) FILTER (l_quantity <= 5), 0, 0, 0, 0]) AS n_nulls, TRUE AS near, "
        "unnest([FALSE, FALSE, FALSE, FALSE, FALSE, FALSE, FALSE, FALSE, FALSE, FALSE, FALSE, TRUE]) AS is_key FROM lineitem"
    ),
    "merge_rows": (
        "WITH a AS (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_totalprice END AS o_totalprice) FROM orders "
        "WHERE o_orderkey % 6 <> 0) "
        "SELECT * FROM a WHERE o_orderkey % 9 <> 0 UNION ALL "
        "SELECT * REPLACE ('Z' AS o_orderstatus) FROM orders WHERE o_orderkey % 9 = 0 UNION ALL "
        "SELECT * REPLACE (-1 - o_orderkey AS o_orderkey) FROM orders WHERE o_orderkey % 5 = 0"
    ),
    "read_changes": _CHANGED,
    "alter_columns": (
        "SELECT p_partkey, p_name AS title, p_size::BIGINT + CASE WHEN p_size >= 30 THEN 1099511627776 ELSE 0 END AS p_size, "
        "CASE WHEN p_size >= 30 THEN 7 END AS p_type FROM part"
    ),
    "expire_versions": (
        "SELECT v AS version, v > 2 AS kept, CASE WHEN v > 2 THEN count(s_suppkey) FILTER (s_suppkey % 4 >= v - 1) END AS n_rows "
        "FROM supplier, (VALUES (1), (2), (3), (4)) t(v) GROUP BY v"
    ),
    "read_where": "SELECT * FROM lineitem WHERE l_orderkey BETWEEN 100 AND 900 AND l_quantity >= 10",
    "cluster_dataset": (
        "SELECT count(*) AS n_rows, TRUE AS few_files FROM lineitem, (SELECT max(l_partkey) AS p, max(l_suppkey) AS s FROM lineitem) "
        "WHERE l_partkey BETWEEN 1 AND p // 4 AND l_suppkey BETWEEN 1 AND s // 4"
    ),
    "append_create_race": "SELECT * FROM orders",
    "sweep_during_publish": (
        "SELECT count(*) AS n_rows, sum(c_custkey)::BIGINT AS keys, count(*) AS total_rows, FALSE AS accepted, 1 AS swept "
        "FROM customer WHERE c_custkey % 2 = 0"
    ),
    "path_after_failed_write": "SELECT * FROM nation",
}
