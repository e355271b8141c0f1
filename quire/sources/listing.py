"""Existence of many paths at once (E1/E2 for a list of paths).

Existence of the roots is a metadata call per path given (the list is already on
the driver); everything about files is one ``binaryFile`` scan without the
``content`` column, so Spark lists in parallel and reads no file bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quire.context import Context
from quire.functions.catalogue import datasets
from quire.sources import filesystem as fsys


def norm(col: F.Column) -> F.Column:
    """``file:/x``, ``file:///x`` and ``/x`` compare equal; no trailing slash."""
    return F.regexp_replace(F.regexp_replace(col, r"^file:/+", "/"), r"/+$", "")


def files_under(ctx: Context, roots: Sequence[str]) -> DataFrame:
    """(path, length, modificationTime) of every visible data file below the
    existing ``roots``. Hidden names (``_SUCCESS``, ``_temporary``) are skipped."""
    spark = ctx.spark
    if not roots:
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(roots))
        .select("path", "length", "modificationTime")
    )


def ancestors(path_col: F.Column) -> F.Column:
    """Array of every ancestor folder of a normalised absolute path, and the
    path itself (so a root that is a file matches its own listing row)."""
    parts = F.split(path_col, "/")
    return F.transform(
        F.sequence(F.lit(2), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, 1, i), "/"),
    )


def per_root(ctx: Context, roots: Sequence[str], roots_df: DataFrame) -> DataFrame:
    """(root, n_files, bytes) for each root in ``roots_df`` (column ``root``,
    normalised) from one listing of ``roots``: each file is matched to the roots
    above it by an equi-join on its ancestor folders."""
    files = files_under(ctx, roots)
    anc = files.select(
        F.explode(ancestors(norm(F.col("path")))).alias("root"), "length"
    )
    keys = roots_df.select("root").distinct()
    return (
        anc.join(keys, "root")
        .groupBy("root")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
    )


def exists_report(ctx: Context, paths: Sequence[str]) -> DataFrame:
    """(path, exists, has_files, n_files, bytes, is_dataset, dataset_id) per path.

    ``has_files``: at least one visible data file below it. ``is_dataset``: the
    path is the root or ``Processed`` folder of a live dataset of this catalogue.
    A failure to list raises; it is never reported as "absent".
    """
    if isinstance(paths, str) or not all(isinstance(p, str) and p for p in paths):
        raise TypeError("paths must be a list of non-empty strings")
    spark = ctx.spark
    rows = fsys.each(lambda p: (p, fsys.qualify(spark, p), fsys.exists(spark, p)), paths)
    given = spark.createDataFrame(rows, "path string, qualified string, exists boolean").withColumn(
        "root", norm(F.col("qualified"))
    )
    existing = [q for _, q, ok in rows if ok]
    counts = per_root(ctx, existing, given)
    ds = datasets(ctx).select(
        "dataset_id", norm(F.col("folder")).alias("_folder")
    )
    ds_keys = ds.select(F.col("_folder").alias("root"), "dataset_id").unionByName(
        ds.select(F.concat(F.col("_folder"), F.lit("/Processed")).alias("root"), "dataset_id")
    )
    return (
        given.join(counts, "root", "left")
        .join(ds_keys, "root", "left")
        .select(
            "path",
            "exists",
            (F.coalesce("n_files", F.lit(0)) > 0).alias("has_files"),
            F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files"),
            F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
            F.col("dataset_id").isNotNull().alias("is_dataset"),
            "dataset_id",
        )
    )
