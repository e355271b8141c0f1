"""Which commits a reader sees.

A dataset's commits are ordered by version. Its last commit names the version at which
what is live begins (``reset_version``): the last overwrite, compaction or deletion.
Commits from there on are live, and so are the earlier ones that a compaction carried on; a
deletion is never live. Replacements leave older commits live and hide rows of theirs.

The last commit of each dataset is a partial aggregate, so a dataset that holds most
commits is not gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def latest(log: DataFrame, attrs: list[str]) -> DataFrame:
    """One row per dataset: ``attrs`` of its last commit."""
    return log.groupBy("dataset_id").agg(
        F.max_by(F.struct(*[F.col(a) for a in attrs]), F.col("version")).alias("_last")
    ).select("dataset_id", "_last.*")


def with_live(log: DataFrame) -> DataFrame:
    """``log`` with ``live``: whether readers see the commit now."""
    resets = latest(log, ["reset_version"]).withColumnRenamed("reset_version", "_reset")
    c = log.join(resets, "dataset_id")
    carried = (
        c.filter((F.col("version") == F.col("_reset")) & (F.size(F.coalesce("carried", F.array())) > 0))
        .select("dataset_id", F.explode("carried.version").alias("version"), F.lit(True).alias("_carried"))
    )
    live: Column = ((F.col("version") >= F.col("_reset")) & (F.col("mode") != "delete")) | F.coalesce("_carried", F.lit(False))
    return c.join(carried, ["dataset_id", "version"], "left").withColumn("live", live).drop("_reset", "_carried")
