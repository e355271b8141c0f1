"""Resampling towards a target distribution by hashed n-gram importance weights.

Each feature (a run of words) falls into one of a fixed number of buckets by its CRC-32. The log ratio
of a bucket's share in the target texts to its share in the source documents is its gain; a document's
weight is the mean gain of its features; Gumbel noise keyed by the document's id turns the weights
into a draw without replacement: the highest scores are drawn.

The CRCs of a run of documents are computed together: its distinct features are grouped by equal
length into byte matrices, one table step a column advances the CRCs of all rows, and the buckets are
scattered back to the features' places. Features longer than a row are cut into rows, whose
registers are put together by the linearity of the CRC.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import byte_values, runs, written

BUCKETS, SHARE, LEAST_WORDS, SEED = 10_000, 10, 20, 2024
_ROW = 64  # bytes of a matrix row; longer features take several
_RUN = 1 << 20

#: A-Z to lower case; every other byte outside a-z, 0-9 and UTF-8 sequences parts words.
_FOLD = bytes(b | 0x20 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def crc_table() -> np.ndarray:
    """The step of a byte for the reflected polynomial 0xEDB88320."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_STEP = crc_table()


def _columns(matrix: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The registers ``crc`` of all rows after the bytes of the matrix, column by column."""
    for column in np.ascontiguousarray(matrix.T):
        crc = _STEP[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return crc


def _shift_tables() -> np.ndarray:
    """What a row of zero bytes makes of each register byte."""
    starts = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)).ravel()
    return _columns(np.zeros((1024, _ROW), np.uint8), starts).reshape(4, 256)


_SHIFT = _shift_tables()


def _long_crc(data: bytes) -> int:
    """CRC of a feature over one row long: leading zeros leave a zero register as it is, so the
    feature is padded in front, and the start value goes into its first four bytes."""
    pad = -len(data) % _ROW
    buf = np.zeros(pad + len(data), np.uint8)
    buf[pad:] = np.frombuffer(data, np.uint8)
    buf[pad : pad + 4] ^= 255
    rows = _columns(buf.reshape(-1, _ROW), np.zeros(len(buf) // _ROW, np.uint32)).tolist()
    a, b, c, d = _SHIFT.tolist()
    crc = 0
    for r in rows:
        crc = a[crc & 255] ^ b[crc >> 8 & 255] ^ c[crc >> 16 & 255] ^ d[crc >> 24] ^ r
    return crc ^ 0xFFFFFFFF


def crc32_many(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each feature (uint32), by matrices of features of equal length."""
    out = np.zeros(len(features), np.uint32)
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    cuts = np.flatnonzero(np.diff(sizes, prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], len(features)]):
        places, n = order[lo:hi], int(sizes[lo])
        if n > _ROW:
            out[places] = [_long_crc(features[i]) for i in places]
        elif n:
            matrix = np.frombuffer(b"".join([features[i] for i in places]), np.uint8).reshape(-1, n)
            out[places] = _columns(matrix, np.full(len(places), 0xFFFFFFFF, np.uint32)) ^ np.uint32(0xFFFFFFFF)
    return out


def _features(texts: list[bytes], most: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All features of the texts in order, how many each text has, and its number of words."""
    out: list[bytes] = []
    counts, words = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = t.translate(_FOLD).split()
        before = len(out)
        out += w
        for n in range(2, most + 1):
            out += [b" ".join(w[j : j + n]) for j in range(len(w) - n + 1)]
        counts[i], words[i] = len(out) - before, len(w)
    return out, counts, words


def feature_buckets(texts: list[bytes], buckets: int = BUCKETS, most: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature in order, features of each text, words of each text."""
    features, counts, words = _features(texts, most)
    place: dict[bytes, int] = {}
    at = np.fromiter((place.setdefault(f, len(place)) for f in features), np.int64, len(features))
    return (crc32_many(list(place)) % np.uint32(buckets)).astype(np.int64)[at], counts, words


def _text_runs(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        texts = byte_values(batch.column(column))
        for lo, hi in runs(texts, _RUN):
            yield batch.slice(lo, hi - lo), texts[lo:hi]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, most: int = 1) -> DataFrame:
    """(bucket, n): features in each bucket over all rows of ``texts``. A task adds up its own part first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, run in _text_runs(batches, 0):
            total += np.bincount(feature_buckets(run, buckets, most)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    rows = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, most: int = 1) -> np.ndarray:
    """The gain of each bucket: a table of fixed size."""
    both = (
        docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
        .join(bucket_counts(docs, buckets, most).withColumnRenamed("n", "s"), "bucket", "left")
        .join(bucket_counts(target, buckets, most).withColumnRenamed("n", "t"), "bucket", "left").na.fill(0)
    )
    rows = np.array([tuple(r) for r in both.select("bucket", "s", "t").collect()], np.int64)
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    s[rows[:, 0]], t[rows[:, 0]] = rows[:, 1], rows[:, 2]
    up, down = (t + 1.0) * float(s.sum() + buckets), (s + 1.0) * float(t.sum() + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, most: int = 1) -> DataFrame:
    """doc_id, n_features, n_words, weight of every row: the floored mean gain of its features."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, run in _text_runs(batches, 1):
            at, counts, words = feature_buckets(run, buckets, most)
            sums = np.concatenate(([0], np.cumsum(gain[at])))
            ends = np.cumsum(counts)
            weight = (sums[ends] - sums[ends - counts]) // np.maximum(counts, 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts), pa.array(words), pa.array(weight)], ["doc_id", "n_features", "n_words", "weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        weigh, "doc_id long, n_features long, n_words long, weight long")


def resampled(
    docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, most: int = 1, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, n_words, weight, score, rank of every row of ``docs`` (doc_id, text, ...).

    ``target`` holds texts of the distribution wanted. Of the rows with an id and ``least_words`` words or
    more, floor(``share`` %) are drawn: the highest scores, ties to the smaller doc_id, ``rank`` 1, 2, 3...;
    it is null for the others. ``most``: longest run of words that is a feature.

    Null, empty and wordless texts have no features, weight 0 and are never drawn. A row without id has no
    score and no rank. Rows that share an id are drawn row by row; among those with the same score the order
    is any. Other columns are ignored, whatever their names. Empty ``docs`` give an empty result, an
    empty ``target`` counts as one with no features. A text of any length is weighed as a whole.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    may = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    rows = weighted(docs, gains(docs, target, buckets, most), most).withColumn("score", F.col("weight") + noise)
    # numbered within range partitions; the partitions' sizes then give every row's place. Rows that are not
    # drawn from stand at the end, in a range of their own; the hash parts rows that share id and score
    order = [may.desc(), F.col("score").desc(), F.col("doc_id"), F.xxhash64("weight", "n_features", "n_words"), F.col("any")]
    rows = written(rows.withColumn("any", F.monotonically_increasing_id()), "weighted")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("any")
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()), "placed")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.when(may, 1)).alias("n")).orderBy("part").collect()
    drawn = sum(r["n"] for r in sizes) * share // 100
    before, total = [], 0
    for r in sizes:  # one for each partition
        before.append((r["part"], total))
        total += r["n"]
    starts = docs.sparkSession.createDataFrame(before, "part long, start long")
    out = placed.withColumn("part", part.cast("long")).join(F.broadcast(starts), "part")
    rank = F.col("start") + within + 1
    return out.select(
        "doc_id", "n_features", "n_words", "weight", "score", F.when(may & (rank <= drawn), rank).alias("rank"))
