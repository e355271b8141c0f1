"""Task retries (the local stand-in for lost executors) during a publish."""

import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    import quire as q

    spark = (SparkSession.builder.master("local[4,3]")  # each task may fail and be retried
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.udf(T.LongType())
    def flaky(x):
        tc = TaskContext.get()
        if tc.attemptNumber() == 0 and tc.partitionId() % 2 == 0:
            raise RuntimeError("task lost")
        return x

    ctx = q.Context.scratch(spark, "retries")
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").repartition(6)
    out = q.publish(ctx, li.withColumn("l_orderkey", flaky("l_orderkey")), "lineitem", "d")
    n = li.count()
    back = q.read_dataset(ctx, out["dataset_id"])
    assert out["accepted"], out
    assert out["n_rows"] == n, (out["n_rows"], n)
    assert back.count() == n and back.exceptAll(li).count() == 0
    print("RETRIES-OK", out["n_rows"])
    """
)


def test_publish_survives_task_retries():
    proc = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=str(ROOT))],
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert "RETRIES-OK" in proc.stdout, proc.stdout[-2000:] + proc.stderr[-4000:]
