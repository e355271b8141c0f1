"""Ranked search over the catalogue: BM25 on an inverted index, and near words for misspelt ones.

A dataset's document is its name, description, tags (keys and values) and column names; its terms are the runs of
letters and digits, in lower case. A posting says how often a dataset has a term. Query terms that
no dataset has stand for the terms that share most trigrams with them.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, functions as F

from quire.context import Context
from quire.functions.catalogue import datasets, schemas

K1, B = 1.2, 0.75
LIKENESS = 0.3  # least share of trigrams of a term that stands for a misspelt one
_TERM = r"[\p{L}\p{N}]+"


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


def postings(ctx: Context) -> DataFrame:
    """The inverted index: term, dataset_id, tf (occurrences), length (terms of the dataset's document)."""
    columns = schemas(ctx).groupBy("schema_id").agg(F.concat_ws(" ", F.collect_list("column_name")).alias("columns"))
    tags = F.concat_ws(" ", F.transform(F.map_entries("tags"), lambda e: F.concat_ws(" ", e["key"], F.concat_ws(" ", e["value"]))))
    text = F.concat_ws("\n", "name", "description", tags, "columns")
    docs = datasets(ctx).join(columns, "schema_id", "left").select("dataset_id", _terms(text).alias("terms"))
    docs = docs.select("dataset_id", F.size("terms").cast("long").alias("length"), F.explode("terms").alias("term"))
    return docs.groupBy("term", "dataset_id", "length").agg(F.count(F.lit(1)).alias("tf"))


def write_index(ctx: Context) -> str:
    """Stores the postings, sorted by term so that a search reads few of them; returns the folder. The
    index is of the catalogue as it is now."""
    path = f"{ctx.catalogue_dir}/index/{uuid.uuid4().hex}"
    parts = int(ctx.spark.conf.get("spark.sql.shuffle.partitions"))
    postings(ctx).repartitionByRange(parts, "term").sortWithinPartitions("term").write.parquet(path)
    return path


def _trigrams(word: Column) -> Column:
    padded = F.concat(F.lit("  "), word, F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


def _resolved(index: DataFrame, words: list[str]) -> DataFrame:
    """(word, term, weight): each query word itself where the index has it, else the likest terms."""
    spark = index.sparkSession
    asked = F.broadcast(spark.createDataFrame([(w,) for w in words], "word string"))  # the words of one query
    vocabulary = index.select("term").distinct()
    exact = vocabulary.join(asked, F.col("term") == F.col("word")).select("word", "term", F.lit(1.0).alias("weight"))
    absent = asked.join(exact.select("word"), "word", "left_anti")
    grams = absent.withColumn("g", F.explode(_trigrams(F.col("word"))))
    sizes = absent.withColumn("words", F.size(_trigrams(F.col("word"))))
    shared = vocabulary.withColumn("t", _trigrams(F.col("term"))).select("term", F.size("t").alias("terms"), F.explode("t").alias("g"))
    pairs = shared.join(F.broadcast(grams), "g").groupBy("word", "term", "terms").agg(F.count(F.lit(1)).alias("both"))
    like = F.col("both") / (F.col("terms") + F.col("words") - F.col("both"))
    pairs = pairs.join(sizes, "word").select("word", "term", like.alias("weight")).filter(F.col("weight") >= LIKENESS)
    best = pairs.groupBy("word").agg(F.max("weight").alias("best"))
    near = pairs.join(best, "word").filter(F.col("weight") == F.col("best")).select("word", "term", "weight")
    return exact.unionByName(near)


def ranked_search(ctx: Context, text: str, index: str | None = None) -> DataFrame:
    """dataset_id, name, score of the datasets that have words of ``text``, or terms like words that none has.

    The score is the sum over words of idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean length)), with
    idf = ln(1 + (n - df + 0.5) / (df + 0.5)), k1 = 1.2 and b = 0.75; of a term that stands for a misspelt word, times its
    share of trigrams. ``index``: a folder that ``write_index`` gave, else the catalogue is indexed now. Order
    and cut are the caller's: ``.orderBy(F.desc("score")).limit(10)``.
    """
    if not isinstance(text, str) or not text.strip():
        raise TypeError("text must be a non-empty string")
    words = sorted(set(re.findall(r"[^\W_]+", text.lower())))
    if not words:
        raise ValueError("text has no letters or digits")
    rows = postings(ctx) if index is None else ctx.spark.read.parquet(index)
    sizes = rows.select("dataset_id", "length").distinct()
    whole = sizes.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    found = _resolved(rows, words)
    hits = rows.join(F.broadcast(found), "term")  # at most the query's words and the terms nearest to them
    counts = hits.groupBy("word", "term").agg(F.count(F.lit(1)).alias("df"))
    hits = hits.join(F.broadcast(counts), ["word", "term"]).crossJoin(F.broadcast(whole))  # one row
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean"))
    scored = hits.groupBy("dataset_id").agg(F.sum(F.col("weight") * idf * F.col("tf") * (K1 + 1) / norm).alias("score"))
    return scored.join(datasets(ctx).select("dataset_id", "name"), "dataset_id").select("dataset_id", "name", "score")
