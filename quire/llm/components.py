"""Connected components of an edge table: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) as ``(node, label)``: the smallest node that each can reach.

    Each round joins every node with the least neighbour found by a partial aggregate,
    so a node with very many links is never gathered. Rounds are written to the
    shared folder. An empty edge table gives an empty result.
    """
    e = written(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v").distinct(), "cc",
    )
    while True:
        # done when no label has a smaller neighbour, that is, all components are stars
        if e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty():
            least = e.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("w"))
            if least.filter("v < w").isEmpty():
                break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        small = small.select("v", "m").unionByName(down.select(F.col("u").alias("v"), "m"))
        e = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "cc")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
