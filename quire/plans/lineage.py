"""Lineage between datasets: edges and their transitive closure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire.context import Context
from quire.functions.catalogue import datasets, lineage


def edges(ctx: Context) -> DataFrame:
    """(input_dataset_id, dataset_id) between live datasets, by their live commits, distinct."""
    live = datasets(ctx).select("dataset_id")
    return (
        lineage(ctx)
        .select("input_dataset_id", "dataset_id")
        .distinct()
        .join(live, "dataset_id", "left_semi")
        .join(live.withColumnRenamed("dataset_id", "input_dataset_id"), "input_dataset_id", "left_semi")
    )


def lineage_edges(ctx: Context) -> DataFrame:
    """Edges with names: (input_dataset_id, input_name, dataset_id, output_name)."""
    names = datasets(ctx).select("dataset_id", "name")
    return (
        edges(ctx)
        .join(names.select(F.col("dataset_id").alias("input_dataset_id"), F.col("name").alias("input_name")), "input_dataset_id")
        .join(names.select("dataset_id", F.col("name").alias("output_name")), "dataset_id")
        .select("input_dataset_id", "input_name", "dataset_id", "output_name")
    )


def lineage_closure(ctx: Context, dataset_id: str, direction: str = "down", max_depth: int | None = None) -> DataFrame:
    """Everything downstream (``down``) or upstream (``up``) of a dataset with
    the shortest distance; the start itself is left out.

    Breadth-first: each round joins the frontier to the edges and removes nodes
    already reached (anti join), so cycles end. Each round is checkpointed to
    the shared checkpoint folder, so the plan does not grow with the depth and a
    lost executor recomputes one round only.
    """
    if direction not in ("down", "up"):
        raise ValueError("direction must be 'down' or 'up'")
    spark = ctx.spark
    e = edges(ctx)
    src, dst = ("input_dataset_id", "dataset_id") if direction == "down" else ("dataset_id", "input_dataset_id")
    e = e.select(F.col(src).alias("src"), F.col(dst).alias("node")).checkpoint()
    reached = spark.createDataFrame([(dataset_id, 0)], "node string, distance int")
    frontier = reached.select("node")
    depth = 0
    while max_depth is None or depth < max_depth:
        depth += 1
        nxt = (
            frontier.select(F.col("node").alias("src"))
            .join(e, "src")
            .select("node")
            .distinct()
            .join(reached.select("node"), "node", "left_anti")
            .withColumn("distance", F.lit(depth))
            .checkpoint()
        )
        if nxt.isEmpty():
            break
        reached = reached.unionByName(nxt)  # a union of checkpointed rounds
        frontier = nxt.select("node")
    names = datasets(ctx).select(F.col("dataset_id").alias("node"), F.col("name").alias("dataset_name"))
    return (
        reached.filter(F.col("distance") > 0)
        .join(names, "node")
        .select(F.col("node").alias("dataset_id"), "dataset_name", "distance")
    )
