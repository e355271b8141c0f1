"""Benchmark of the catalogue operators against plain Spark on the same data.

Prints one JSON line. Environment: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_RUNS (default 5, median after one warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession, functions as F  # noqa: E402

from quire import (  # noqa: E402
    Context,
    catalogue_datasets,
    compact_dataset,
    merge_rows,
    publish,
    publish_many,
    read_changes,
    read_dataset,
    read_where,
    replace_partition,
    sweep_orphans,
)
from quire.sources import filesystem as fsys  # noqa: E402
from quire.sources.catalogue_log import STARTED, encode, entry_path, last_entry, note_version  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


JOBS: dict[str, list[int]] = {}


def count_jobs(name, fn):
    """[jobs, stages] Spark ran for one call of ``fn`` (job group + status tracker)."""
    sc = SparkSession.getActiveSession().sparkContext
    group = f"bench-{name}-{uuid.uuid4().hex[:6]}"
    sc.setJobGroup(group, name)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    ids = tracker.getJobIdsForGroup(group)
    stages = 0
    for j in ids:
        info = tracker.getJobInfo(j)
        stages += len(info.stageIds) if info else 0
    JOBS[name] = [len(ids), stages]


def median_time(fn, runs=RUNS, warmup=1, name=None):
    for _ in range(warmup):
        fn()
    if name:
        count_jobs(name, fn)
    ts = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t)
    return round(statistics.median(ts), 4)


def scan_action(df):
    """Forces every column to be read: a count plus a checksum per column."""
    return df.agg(F.count(F.lit(1)), *[F.bit_xor(F.xxhash64(F.col(c))) for c in df.columns]).collect()


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("quire-bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ctx = Context.scratch(spark, "bench")
    scratch = f"{ctx.base}/plain"
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    nation = spark.read.parquet(f"{SF_DIR}/nation.parquet")
    q = {}

    # W1: publish vs a plain write of the same frame
    q["plain_write_lineitem"] = median_time(lambda: lineitem.write.parquet(f"{scratch}/{uuid.uuid4().hex}"))
    ids = []
    q["w1_publish_lineitem"] = median_time(lambda: ids.append(publish(ctx, lineitem, "lineitem", "lines")["dataset_id"]), name="w1_publish_lineitem")

    # W6: partitioned publish vs a plain partitioned write
    parts = ["o_orderstatus", "o_orderpriority"]
    q["plain_write_orders_partitioned"] = median_time(
        lambda: orders.write.partitionBy(*parts).parquet(f"{scratch}/{uuid.uuid4().hex}")
    )
    q["w6_publish_orders_partitioned"] = median_time(
        lambda: publish(ctx, orders, "orders", "orders", partition_by=parts), name="w6_publish_orders_partitioned"
    )

    # reads: one folder, a dataset of 1 commit, a dataset of 100 commits
    plain = f"{scratch}/read-{uuid.uuid4().hex}"
    lineitem.write.parquet(plain)
    q["plain_read_lineitem"] = median_time(lambda: scan_action(spark.read.parquet(plain)))
    one = ids[-1]
    q["w1_read_by_id_1_commit"] = median_time(lambda: scan_action(read_dataset(ctx, one)), name="w1_read_by_id_1_commit")
    # 100 key ranges covering every row (approximate quantiles, then exact ranges)
    bounds = lineitem.select(F.percentile_approx("l_orderkey", [i / 100 for i in range(1, 100)], 10000).alias("b")).first()["b"]
    edges = [None] + sorted(set(bounds)) + [None]
    slices = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("l_orderkey") > lo)
        if hi is not None:
            cond = cond & (F.col("l_orderkey") <= hi)
        slices.append(lineitem.filter(cond))
    first = publish(ctx, slices[0], "lineitem100", "lines in commits")["dataset_id"]
    specs = [
        {"df": s, "name": "lineitem100", "description": "lines in commits", "dataset_id": first, "mode": "append"}
        for s in slices[1:]
    ]
    for i in range(0, len(specs), 10):
        publish_many(ctx, specs[i:i + 10], parallelism=CPUS).collect()
    q["w3_read_by_id_100_commits"] = median_time(lambda: scan_action(read_dataset(ctx, first)), name="w3_read_by_id_100_commits")
    n_commits = len(slices)

    # replacement of a partition, and reading after it; compaction of the 100 commits
    rep = publish(ctx, orders, "orders", "orders", partition_by="o_orderstatus")["dataset_id"]
    slice_ = orders.filter("o_orderstatus = 'F'")
    q["w9_replace_partition"] = median_time(
        lambda: replace_partition(ctx, slice_, rep, "o_orderstatus = 'F'"), name="w9_replace_partition"
    )
    q["w9_read_after_replacements"] = median_time(lambda: scan_action(read_dataset(ctx, rep)))

    # a merge of one row in a hundred, and reading after ten of them; changes; a read through statistics
    merged = publish(ctx, orders, "orders", "orders", skip_by=["o_orderkey"])["dataset_id"]
    few = orders.filter("o_orderkey % 100 = 0")
    q["s9_merge_rows"] = median_time(lambda: merge_rows(ctx, few, merged, "o_orderkey"), name="s9_merge_rows")
    q["s9_read_after_merges"] = median_time(lambda: scan_action(read_dataset(ctx, merged)), name="s9_read_after_merges")
    q["plain_read_orders"] = median_time(lambda: scan_action(orders))
    q["r3_read_changes"] = median_time(lambda: scan_action(read_changes(ctx, merged, 1)), name="r3_read_changes")
    q["r2_read_where_key"] = median_time(lambda: read_where(ctx, merged, {"o_orderkey": 7}).count(), name="r2_read_where_key")

    q["x2_compact_100_commits"] = median_time(lambda: compact_dataset(ctx, first), runs=1, warmup=0)

    # one log entry for each publish, as users make them: append, read and listing as
    # the catalogue grows
    cctx = Context.scratch(spark, "bench-cat")
    mine = publish(cctx, nation, "mine", "nations", inputs=[])["dataset_id"]
    have = 1

    def other(i):
        ds = str(uuid.uuid4())
        row = {"dataset_id": ds, "version": 1, "reset_version": 1, "mode": "overwrite", "commit_id": f"c{i}",
               "data_folder": f"c{i}.a", "n_rows": 25, "total_rows": 25, "n_live": 1, "name": f"nation_{i}", "tags": {}}
        fsys.create_new(spark, entry_path(cctx, ds, 1), encode([row]))

    for n in (10, 1000, 5000):
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(other, range(have, n)))
        have = n
        q[f"w3_append_{n}_entries"] = median_time(
            lambda: publish(cctx, nation, "mine", "nations", dataset_id=mine, mode="append", inputs=[]), name=f"w3_append_{n}_entries"
        )
        q[f"w1_read_{n}_entries"] = median_time(lambda: read_dataset(cctx, mine).count())
        q[f"w14_list_catalogue_{n}"] = median_time(lambda: catalogue_datasets(cctx).collect(), name=f"w14_list_catalogue_{n}")

    # a lookup in a log of 10 and of 2000 commits
    lctx = Context.scratch(spark, "bench-log")
    for n in (10, 2000):
        ds = str(uuid.uuid4())

        def entry(v, ds=ds):
            row = {"dataset_id": ds, "version": v, "reset_version": v, "mode": "overwrite", "commit_id": f"c{v}", "data_folder": f"c{v}.a",
                   "n_rows": 1, "total_rows": 1, "n_live": 1, "name": "log", "tags": {}}
            fsys.put_bytes(spark, entry_path(lctx, ds, v), encode([row]))

        with ThreadPoolExecutor(16) as pool:
            list(pool.map(entry, range(1, n + 1)))
        note_version(lctx, ds, n - n % 16)
        q[f"c1_lookup_{n}_commits"] = median_time(lambda: last_entry(lctx, ds))  # noqa: B023

    # W15: sweep of 1000 unfinished attempts (a tenth of them with files)
    sctx = Context.scratch(spark, "bench-sweep")
    publish(sctx, nation, "nation", "nations")

    def crash(i):
        ds, name = str(uuid.uuid4()), f"c{i}.a"
        row = {"folder": sctx.commit_dir(ds, name), "dataset_id": ds, "commit_id": f"c{i}", "started_at": sctx.now()}
        fsys.create_new(spark, f"{sctx.started_dir}/{name}.parquet", encode([row], STARTED))
        return row["folder"]

    with ThreadPoolExecutor(16) as pool:
        for d in list(pool.map(crash, range(1000)))[:100]:
            spark.createDataFrame([(1,)], "x int").coalesce(1).write.parquet(d)
    q["w15_sweep_1000_dry_run"] = median_time(
        lambda: sweep_orphans(sctx, older_than=-60).collect(), runs=max(1, RUNS // 2), name="w15_sweep_1000_dry_run"
    )

    headline = [k for k in q if not k.startswith("plain_")]
    out = {
        "metric": "catalogue_ops_total",
        "value": round(sum(q[k] for k in headline), 4),
        "unit": "sec",
        "queries": q,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "runs": RUNS,
        "cpus": CPUS,
        "overhead_vs_plain": {
            "publish_lineitem": round(q["w1_publish_lineitem"] / q["plain_write_lineitem"], 3),
            "publish_orders_partitioned": round(q["w6_publish_orders_partitioned"] / q["plain_write_orders_partitioned"], 3),
            "read_1_commit": round(q["w1_read_by_id_1_commit"] / q["plain_read_lineitem"], 3),
            "read_after_merges": round(q["s9_read_after_merges"] / q["plain_read_orders"], 3),
            "read_100_commits": round(q["w3_read_by_id_100_commits"] / q["plain_read_lineitem"], 3),
        },
        "commits_in_w3_dataset": n_commits,
        "spark_jobs_stages": JOBS,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
