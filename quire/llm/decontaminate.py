"""Benchmark decontamination: shared n-grams, then Smith-Waterman alignment.

One scan of the documents finds the n-grams that the test items have too (a bitmap of fixed
size, then an exact join) and cuts out the passages around them. Every passage and item that share an
n-gram are a pair, whatever other documents hold. A bound on the score, by the words they share, passes over
pairs that cannot be similar enough; the others are aligned word by word. Local alignment forgives
replaced, lost and added words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import bit_filter, byte_values, hash_words, in_filter, odd_constants, released, windows, written

NGRAM = 4
MATCH, MISMATCH, GAP = 2, -1, -1
SIMILARITY = 0.4
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_MULT = odd_constants(NGRAM + 1, 91)
_CELLS = 1 << 21  # score cells of one batch of alignments


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of a text's runs of letters and digits, A-Z lower-cased."""
    return hash_words(_WORD.findall(text.lower()))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    if n == NGRAM:
        return windows(h, n, _MULT)
    return windows(h, n, _MULT[: n + 1]) ^ np.uint64(n)  # items shorter than an n-gram


def _items(benchmark: DataFrame) -> DataFrame:
    """item_id, words (hashes), n, and the item's n-grams in order."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [word_hashes(t) for t in byte_values(batch.column(1))]
            n = [min(len(x), NGRAM) for x in h]
            g = [grams(x, k).view(np.int64) if k else np.empty(0, np.int64) for x, k in zip(h, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in h], pa.binary()), pa.array([len(x) for x in h], pa.int64()),
                 pa.array(n, pa.int32()), pa.array(g, pa.list_(pa.int64()))], ["item_id", "words", "size", "n", "grams"],
            )

    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "item_id long, words binary, size long, n int, grams array<long>"
    )
    return rows.filter("size > 0").withColumn("item", F.monotonically_increasing_id())


def _passages(docs: DataFrame, bits: np.ndarray, sizes: list[int], margin: int) -> DataFrame:
    """doc_id, row, first (word number), words, hits: the parts of each document around n-grams
    that the bitmap knows. Parts closer than ``margin`` words are one."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for doc_id, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), byte_values(batch.column(2))):
                h = word_hashes(text)
                found = []
                for n in sizes:
                    g = grams(h, n)
                    at = np.flatnonzero(in_filter(bits, g))
                    found.append((at, g[at]))
                at, g = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, g = at[order], g[order]
                cut = np.flatnonzero(np.diff(at) > 2 * margin) + 1
                for a, b in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(at)]))):
                    lo, hi = max(0, at[a] - margin), min(len(h), at[b - 1] + NGRAM + margin)
                    out.append((doc_id, row, int(lo), h[lo:hi].tobytes(), np.unique(g[a:b]).view(np.int64)))
                    size += 8 * int(hi - lo)
                if size > 16 << 20:
                    yield _rows(out)
                    out, size = [], 0
            if out:
                yield _rows(out)

    def _rows(out: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "row", "first", "words", "hits"])

    d = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id(), F.col("text").cast("string"))
    return d.mapInArrow(run, "doc_id long, row long, first long, words binary, hits array<long>")


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman score of each item with its passage, and where in the passage the best
    alignment ends. All pairs advance together, an item's word at a time."""
    n, width = len(items), max(map(len, passages))
    deep = max(map(len, items))
    a, b = np.zeros((n, deep), np.uint64), np.zeros((n, width), np.uint64)
    for k, (x, y) in enumerate(zip(items, passages)):
        a[k, : len(x)], b[k, : len(y)] = x, y
    inside = np.arange(width) < np.array([len(y) for y in passages])[:, None]
    sizes = np.array([len(x) for x in items])
    ramp = (np.arange(width) * -GAP).astype(np.int32)
    prior, best, end = np.zeros((n, width), np.int32), np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(deep):
        same = (b == a[:, i : i + 1]) & inside
        diagonal = np.zeros((n, width), np.int32)
        diagonal[:, 1:] = prior[:, :-1]
        row = np.maximum(diagonal + np.where(same, MATCH, MISMATCH).astype(np.int32), prior + GAP)
        np.maximum(row, 0, out=row)
        # gaps along the passage: the best of all cells to the left, less its distance
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp
        row[~inside] = 0
        row[i >= sizes] = 0
        top = row.max(axis=1)
        better = top > best
        best[better], end[better] = top[better], row.argmax(axis=1)[better]
        prior = row
    return best, end


def most(item: np.ndarray, passage: np.ndarray) -> int:
    """No alignment of the two scores more. Of either side an alignment takes a run of words; each of
    them that the other side lacks costs at least 1, any other gives at most a match."""
    best = MATCH * len(item)
    for a, b in ((item, passage), (passage, item)):
        run = np.concatenate(([0], np.cumsum(np.where(np.isin(a, b), MATCH, max(MISMATCH, GAP)))))
        best = min(best, int((run - np.minimum.accumulate(run)).max()))
    return best


def _aligned(pairs: DataFrame, similarity: float) -> DataFrame:
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(5)]
            y = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(3)]
            batch = batch.filter(pa.array([most(a, b) / (MATCH * max(len(a), 1)) >= similarity for a, b in zip(x, y)], pa.bool_()))
            x = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(5)]
            y = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(3)]
            order = np.argsort([len(v) for v in y], kind="stable").tolist()
            score, end = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
            while order:
                part, width = [], len(y[order[-1]])
                while order and (not part or (len(part) + 1) * width <= _CELLS // 16):
                    part.append(order.pop())
                score[part], end[part] = align([x[k] for k in part], [y[k] for k in part])
            similar = score / (MATCH * np.maximum([len(v) for v in x], 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(4), pa.array(score), pa.array(similar),
                 pa.array(end + batch.column(2).to_numpy())],
                ["doc_id", "row", "item_id", "score", "similarity", "end_word"],
            )

    return pairs.select("doc_id", "row", "first", "words", "item_id", "item_words").mapInArrow(
        run, "doc_id long, row long, item_id long, score long, similarity double, end_word long"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, score, similarity, end_word for each pair of a document and a test item
    whose best local alignment reaches ``similarity`` (score by the item's best possible one).

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Null, empty and blank texts
    and items match nothing. Items of fewer than 4 words need a whole occurrence. Null ids are
    kept in the result. Repeated documents and items are each reported once per pair of ids. Other columns are
    ignored, whatever their names. An empty table on either side gives an empty result.
    """
    items = written(_items(benchmark), "items")
    facts = items.agg(F.max("size"), F.collect_set("n")).first()  # at most NGRAM sizes
    margin, sizes = int(facts[0] or 0), sorted(facts[1])
    of_item = items.select("item", F.explode(F.array_distinct("grams")).alias("gram"))
    bits = bit_filter(of_item.select("gram").distinct(), F.col("gram"))
    passages = written(_passages(docs, bits, sizes or [NGRAM], margin).withColumn("passage", F.monotonically_increasing_id()), "passages")
    hits = passages.select("passage", F.explode("hits").alias("gram"))
    pairs = hits.join(of_item, "gram").select("passage", "item").distinct()
    pairs = pairs.join(passages.drop("hits"), "passage")
    pairs = pairs.join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
    out = _aligned(pairs, similarity).filter(F.col("similarity") >= similarity)
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", "score", -F.col("end_word"))).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.score").alias("score"), F.col("b.similarity").alias("similarity"),
                       (-F.col("b.col3")).alias("end_word"))
