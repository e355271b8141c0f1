"""Passages that repeat across documents, found by difference-cover anchors.

A difference cover of a period v is a set of residues D such that every difference modulo v is one of
two members. So for any two places i and j there is a shift below v that puts both on places of
D: two equal passages of at least v - 1 + w words share an anchor, a window of w words that begins on a cover
place in both documents, wherever they stand. Only windows on cover places are hashed and grouped. Every
passage window around an anchor that other documents have too is then extended to its full length and
grouped in turn.

Documents are packed in runs of a few megabytes. A run asks each bucket of the hash space once for each
distinct hash and gets one bit back, so a passage that a third of the documents hold is asked for once a
run, not once a document, and texts only meet the few bits that came back for their own run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import batch_rows, byte_values, fresh_path, hash_words, odd_constants, runs, windows, written

WORDS, PERIOD = 13, 7
_PACK = 2 << 20  # bytes of text in a run
_BUCKET = 8 << 20  # bytes of text behind a bucket
_ROWS = 4  # runs that a Python worker gets at a time
_GROUP = "run long, bucket long, bits binary"


def difference_cover(period: int) -> list[int]:
    """A smallest set of residues whose differences are all residues of the period."""
    for size in range(1, period + 1):
        for d in combinations(range(period), size):
            if len({(a - b) % period for a in d for b in d}) == period:
                return list(d)
    return [0]


class _Run:
    """Words, anchors and windows of a run of documents."""

    def __init__(self, ids: list, texts: list[bytes], words: int, cover: list[int], period: int):
        self.ids, self.words = ids, words
        self.said = [t.split() for t in texts]
        flat = [w for s in self.said for w in s]
        self.sizes = np.fromiter(map(len, self.said), np.int64, len(self.said))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1])) if len(self.sizes) else np.empty(0, np.int64)
        self.hashes = hash_words(flat)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.place = np.arange(len(flat)) - self.starts[self.doc]
        self.left = self.sizes[self.doc] - self.place  # words from here to the document's end
        known = np.array([i is not None for i in ids], bool)
        self.known = known[self.doc] if len(flat) else np.empty(0, bool)
        self.id_of = np.array([0 if i is None else i for i in ids], np.int64)
        self.anchor = words - period + 1
        on = np.isin(self.place % period, cover) & (self.left >= self.anchor) & self.known
        self.anchors = np.flatnonzero(on)
        self.period = period

    def _grams(self, n: int, at: np.ndarray, seed: int) -> np.ndarray:
        return windows(self.hashes, n, odd_constants(n, seed))[at] if len(at) else np.empty(0, np.uint64)

    def anchor_keys(self, buckets: int) -> np.ndarray:
        """Bucket and 32 bits of the hash of each anchor, as one number."""
        h = self._grams(self.anchor, self.anchors, 31)
        return ((h >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Places where a window begins that holds a shared anchor."""
        hit = np.zeros(len(self.hashes) + self.period, np.int32)
        hit[self.anchors[shared]] = 1
        some = np.concatenate(([0], np.cumsum(hit)))
        ok = (self.left >= self.words) & self.known
        at = np.flatnonzero(ok)
        return at[some[at + self.period] > some[at]]

    def window_keys(self, at: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and 64-bit hash of the windows at these places; the bucket is of a hash of its own."""
        other = self._grams(self.words, at, 53)
        return (other >> np.uint64(20)) % np.uint64(buckets), self._grams(self.words, at, 47)


def _bits(parts: list | None) -> np.ndarray:
    """The answers of all buckets, in order of buckets, as one array."""
    out = [np.frombuffer(p["bits"], np.uint8) for p in parts or []]
    return np.concatenate(out).astype(bool) if out else np.empty(0, bool)


def _pack(docs: DataFrame) -> DataFrame:
    """(run, n_bytes, ids, sizes, texts): documents in runs, their texts compressed as one; a document is never cut."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = byte_values(batch.column(1))
            for lo, hi in runs(texts, _PACK):
                sizes = [len(t) for t in texts[lo:hi]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([sum(sizes)], pa.int64()), pa.array([batch.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int64())), pa.array([squeeze.compress(b"".join(texts[lo:hi]))], pa.binary()),
                ], ["n_bytes", "ids", "sizes", "texts"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    packed = rows.mapInArrow(pack, "n_bytes long, ids array<long>, sizes array<long>, texts binary")
    return packed.withColumn("run", F.monotonically_increasing_id())


def _unpack(sizes: list[int], texts: bytes) -> list[bytes]:
    flat, out, at = zstandard.ZstdDecompressor().decompress(texts, max_output_size=max(1, sum(sizes))), [], 0
    for n in sizes:
        out.append(flat[at : at + n])
        at += n
    return out


def _split(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of the stretches of a sorted array."""
    cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1)) if len(bucket) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(bucket)]):
        yield int(bucket[lo]), int(lo), int(hi)


def _shared(table: pa.Table) -> pa.Table:
    """For each run of a bucket: which of its anchors another document has."""
    ones = [np.frombuffer(b.as_buffer(), np.uint32) for b in table.column("once")]
    twos = [np.frombuffer(b.as_buffer(), np.uint32) for b in table.column("twice")]
    values, n = np.unique(np.concatenate(ones + twos), return_counts=True)
    many = (n > 1).astype(np.uint8)
    return pa.table({"run": table.column("run"), "bucket": table.column("bucket"),
                     "bits": pa.array([many[np.searchsorted(values, o)].tobytes() for o in ones], pa.binary())})


def _earlier(table: pa.Table) -> pa.Table:
    """For each run of a bucket: which of its windows a document with a smaller id has."""
    hashes = [np.frombuffer(b.as_buffer(), np.uint64) for b in table.column("hashes")]
    least = [np.frombuffer(b.as_buffer(), np.int64) for b in table.column("least")]
    h, d = np.concatenate(hashes), np.concatenate(least)
    values, back = np.unique(h, return_inverse=True)
    low = np.full(len(values), np.iinfo(np.int64).max)
    np.minimum.at(low, back, d)
    bits = (d > low[back]).astype(np.uint8)
    ends = np.cumsum([0] + [len(x) for x in hashes])
    return pa.table({"run": table.column("run"), "bucket": table.column("bucket"),
                     "bits": pa.array([bits[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())})


def _answers(replies: DataFrame, name: str) -> DataFrame:
    """One row for each run: what its buckets answered, a bit for each hash it asked for."""
    parts = F.sort_array(F.collect_list(F.struct("bucket", "bits")))
    return replies.groupBy("run").agg(parts.alias(name))


def without_repeats(docs: DataFrame, words: int = WORDS, period: int = PERIOD) -> DataFrame:
    """doc_id, n_words, n_removed, spans, text of every row of ``docs`` (doc_id, text, ...).

    A window is ``words`` neighbouring words (``[^\\x20\\x09-\\x0D]+``, unchanged) of one document. Each word
    that lies in a window whose word sequence a document with a smaller doc_id has too is removed; windows are
    judged on the input. ``text``: the words kept, joined by one space. ``spans``: the stretches
    removed, as first word and end.

    Null, empty and blank texts have no words, nothing is removed from them and their text is empty; so with texts of
    fewer than ``words`` words, which stay. A row without id neither loses words nor makes others lose any.
    Rows that share an id are one document: none makes the other lose words. A passage that repeats only inside
    its document stays. Other columns are ignored, whatever their names. An empty table gives an empty result. A
    text of any length is one whole: it is held by one task at a time.

    Windows are compared by 64-bit hashes inside buckets that a second hash gives.
    """
    if not 1 <= period <= words:
        raise ValueError("period must lie between 1 and words")
    spark, cover = docs.sparkSession, difference_cover(period)
    path = fresh_path(spark, "runs")
    with batch_rows(spark, 1000):
        _pack(docs).write.option("parquet.block.size", str(16 << 20)).parquet(path)
    packed = spark.read.schema("n_bytes long, ids array<long>, sizes array<long>, texts binary, run long").parquet(path)
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(8, math.ceil(total / _BUCKET))

    def runs_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, _Run]]:
        for i in range(batch.num_rows):
            ids, sizes, texts = (batch.column(k)[i].as_py() for k in (1, 2, 3))
            yield i, batch.column(0)[i].as_py(), _Run(ids, _unpack(sizes, texts), words, cover, period)

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, run, r in runs_of(batch):
                # distinct in each document, then how many documents of the run have it
                keys = r.anchor_keys(buckets)
                pairs = np.lexsort((r.id_of[r.doc[r.anchors]], keys))
                k, d = keys[pairs], r.id_of[r.doc[r.anchors]][pairs]
                new = np.ones(len(k), bool)
                new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
                values, n = np.unique(k[new], return_counts=True)
                low = values.astype(np.uint32)
                out = [(run, b, low[lo:hi].tobytes(), low[lo:hi][n[lo:hi] > 1].tobytes())
                       for b, lo, hi in _split((values >> np.uint64(32)).astype(np.int64))]
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["run", "bucket", "once", "twice"])

    def shared_of(r: _Run, answer) -> np.ndarray:
        """Which of the run's anchors, in order of place, other documents have."""
        _, back = np.unique(r.anchor_keys(buckets), return_inverse=True)
        return _bits(answer)[back] if len(back) else np.empty(0, bool)

    def window_order(r: _Run, at: np.ndarray) -> tuple:
        """The run's distinct windows in the order in which it asks for them, the number of each place's
        window, and the smallest id of the run that has it."""
        bucket, h = r.window_keys(at, buckets)
        order = np.lexsort((h, bucket))
        b, h = bucket[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (b[1:] != b[:-1]) | (h[1:] != h[:-1])
        number = np.empty(len(at), np.int64)
        number[order] = np.cumsum(new) - 1
        least = np.full(int(new.sum()), np.iinfo(np.int64).max)
        np.minimum.at(least, number, r.id_of[r.doc[at]])
        return b[new].astype(np.int64), h[new], number, least

    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, run, r in runs_of(batch):
                at = r.candidates(shared_of(r, batch.column(4)[i].as_py()))
                b, h, _, least = window_order(r, at)
                out = [(run, k, h[lo:hi].tobytes(), least[lo:hi].tobytes()) for k, lo, hi in _split(b)]
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["run", "bucket", "hashes", "least"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, r in runs_of(batch):
                at = r.candidates(shared_of(r, batch.column(4)[i].as_py()))
                _, _, number, least = window_order(r, at)
                gone = at
                if len(at):
                    gone = at[(r.id_of[r.doc[at]] > least[number]) | _bits(batch.column(5)[i].as_py())[number]]
                edge = np.zeros(len(r.hashes) + 1, np.int64)
                np.add.at(edge, gone, 1)
                np.add.at(edge, gone + words, -1)
                removed = np.cumsum(edge)[:-1] > 0
                for lo, hi in runs([b" " * int(8 * n) for n in r.sizes], 1 << 20):
                    rows = []
                    for k in range(lo, hi):
                        a, n, said = int(r.starts[k]), int(r.sizes[k]), r.said[k]
                        out = removed[a : a + n]
                        if out.any():
                            steps = np.flatnonzero(np.diff(out.astype(np.int8), prepend=0, append=0))
                            spans = [{"start": int(x), "end": int(y)} for x, y in zip(steps[::2], steps[1::2])]
                            said = [said[j] for j in np.flatnonzero(~out)]
                        else:
                            spans = []
                        rows.append((r.ids[k], n, int(out.sum()), spans, b" ".join(said)))
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays([*columns[:4], columns[4].cast(pa.string())], ["doc_id", "n_words", "n_removed", "spans", "text"])

    texts = packed.select("run", "ids", "sizes", "texts")
    with batch_rows(spark, _ROWS):
        asked = texts.mapInArrow(ask_anchors, "run long, bucket long, once binary, twice binary")
        found = written(_answers(asked.groupBy("bucket").applyInArrow(_shared, _GROUP), "shared"), "shared")
        known = texts.join(found, "run", "left")
        asked = known.mapInArrow(ask_windows, "run long, bucket long, hashes binary, least binary")
        gone = written(_answers(asked.groupBy("bucket").applyInArrow(_earlier, _GROUP), "gone"), "gone")
    kind = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, text string"
    return written(known.join(gone, "run", "left").mapInArrow(cut, kind), "cut", _ROWS)
