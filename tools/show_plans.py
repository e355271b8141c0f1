"""Print the physical plans of the main operators (``explain("formatted")``), as they were in the end: each is run first.

    python tools/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession, functions as F  # noqa: E402

import quire as q  # noqa: E402
from quire.sources.catalogue_log import dataset_log  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    df._jdf.queryExecution().toRdd().count()  # the adaptive plan is final once it has run
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue().split("+- == Initial Plan ==")[0]
    keep = []
    for line in text.splitlines():
        if line.startswith("(") or line.startswith(("Location", "PartitionFilters", "PushedFilters", "ReadSchema", "Arguments", "Keys", "Functions", "Condition", "Join type", "Join condition")):
            keep.append(line)
        elif not line.strip():
            continue
        elif not line.startswith(("Input", "Output", "Batched", "Aggregate Attributes", "Results")):
            keep.append(line)
    return "\n".join(keep)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.ui.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ctx = q.Context.scratch(spark, "plans")
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    ds = q.publish(ctx, orders, "orders", "o", partition_by="o_orderstatus")["dataset_id"]
    cs = q.publish(ctx, cust, "customer", "c", partition_by="c_mktsegment")["dataset_id"]
    q.replace_partition(ctx, cust.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0)), cs,
                        "c_mktsegment = 'BUILDING'")
    ms = q.publish(ctx, orders, "orders", "o", skip_by=["o_orderkey"])["dataset_id"]
    q.merge_rows(ctx, orders.filter("o_orderkey % 100 = 0").withColumn("o_totalprice", F.lit(0.0)), ms, "o_orderkey")
    sections = [
        ("Read by id: filter on a data column and a partition column, two columns projected",
         q.read_dataset(ctx, ds).filter("o_totalprice > 1000 AND o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")),
        ("Read after a replacement: one scan, and one join with the replaced partition values",
         q.read_dataset(ctx, cs).filter("c_nationkey = 3").select("c_custkey", "c_acctbal")),
        ("Read after a merge: one scan, and one anti-join with the places that it hides",
         q.read_dataset(ctx, ms).filter("o_totalprice > 1000").select("o_orderkey", "o_totalprice")),
        ("Changes of a merge", q.read_changes(ctx, ms, 1).select("o_orderkey", "_change")),
        ("Rows of one key through the files' statistics", q.read_where(ctx, ms, {"o_orderkey": 7})),
        ("Catalogue listing with row counts (W14)", q.catalogue_datasets(ctx)),
        ("Lookup of one dataset's commits (first step of every read)",
         dataset_log(ctx, ds).filter("version >= 1").select("version", "commit_id", "mode")),
        ("Partition counts (W7)", q.partition_counts(ctx, ds)),
    ]
    print("# Physical plans\n")
    print(f"Generated by `python tools/show_plans.py {sf}` on Spark {spark.version}; "
          "operator inputs/outputs trimmed.\n")
    for title, df in sections:
        print(f"## {title}\n\n```\n{plan(df)}\n```\n")


if __name__ == "__main__":
    main()
