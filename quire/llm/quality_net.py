"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every token has a sparse ternary index vector from a seeded generator. A word's vector is
the sum of the index vectors of its neighbours over the whole corpus. Words share
``buckets`` rows by hash, so the table has a fixed size whatever the corpus. A
document is the weighted mean and spread of its words' vectors, how alike words one and two
places apart are, and its length. A network with one hidden layer
(numpy) is trained on a bounded sample of labelled documents; a temperature fitted on
rows kept apart calibrates its probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import batch_rows, byte_values, released, runs, written

TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^\sA-Za-z0-9\x80-\xff]+")
_BLOCK = 256  # table rows that are added up together
_COUNTED = 4 << 20  # bytes of text between two additions to a task's whole table
_FAN_IN = 64  # partial tables that one task adds up


@dataclass(frozen=True)
class Settings:
    """``max_train`` bounds the labelled rows that the driver holds: the expected size of a sample
    by hash of the id."""

    buckets: int = 1 << 15
    dims: int = 64
    ones: int = 4
    window: int = 2
    hidden: int = 32
    max_train: int = 20_000
    epochs: int = 40
    seed: int = 11


def _index_vectors(s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each bucket's index vector."""
    r = np.random.default_rng(s.seed)
    places = np.argsort(r.random((s.buckets, s.dims), dtype=np.float32), axis=1)[:, : s.ones]
    return places.astype(np.int64), r.choice(np.array([-1.0, 1.0]), (s.buckets, s.ones))


def _tokens(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Token buckets of all texts in a row, and the number of tokens of each text."""
    words, counts = [], np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = TOKEN.findall(t)
        words.extend(w)
        counts[i] = len(w)
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (buckets - 1), counts


def _context_sums(t: np.ndarray, doc: np.ndarray, s: Settings, places, signs, out: np.ndarray) -> None:
    """Adds to ``out`` (buckets x dims) the index vectors of each token's neighbours."""
    for gap in range(1, s.window + 1):
        same = doc[:-gap] == doc[gap:]
        for a, b in ((t[:-gap][same], t[gap:][same]), (t[gap:][same], t[:-gap][same])):
            row = a * s.dims
            for j in range(s.ones):
                out += np.bincount(row + places[b, j], signs[b, j], out.size)


def word_table(docs: DataFrame, s: Settings = Settings()) -> np.ndarray:
    """buckets x (dims + 1): context sums, and in the last column the tokens' counts, over
    all texts. Partial tables are added up in a tree, block by block."""

    @released
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = _index_vectors(s)
        sums, counts, part = np.zeros(s.buckets * s.dims), np.zeros(s.buckets), None
        for batch in batches:
            part = batch.column(1)[0].as_py() if batch.num_rows else part
            texts = byte_values(batch.column(0))
            for lo, hi in runs(texts, _COUNTED):
                t, n = _tokens(texts[lo:hi], s.buckets)
                counts += np.bincount(t, minlength=s.buckets)
                _context_sums(t, np.repeat(np.arange(hi - lo), n), s, places, signs, sums)
        if part is None:
            return
        table = np.column_stack((sums.reshape(s.buckets, s.dims), counts))
        n = s.buckets // _BLOCK
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int32()), pa.array([part] * n, pa.int32()),
             pa.array([b.tobytes() for b in np.split(table, n)], pa.binary())], ["block", "slot", "sums"],
        )

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer()) for x in t.column("sums"))
        return pa.table({"block": t.column("block")[:1], "slot": t.column("slot")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "block int, slot int, sums binary"
    d = docs.select(F.col("text").cast("string"), F.spark_partition_id())
    rows, slots = d.mapInArrow(partial, schema), max(1, d.rdd.getNumPartitions())
    while slots > 1:
        slots = -(-slots // _FAN_IN)
        rows = rows.withColumn("slot", F.expr(f"cast(slot div {_FAN_IN} AS int)")).groupBy("block", "slot").applyInArrow(add, schema)
    table = np.zeros((s.buckets, s.dims + 1))
    with batch_rows(docs.sparkSession, 1000):
        found = rows.collect()  # buckets x dims numbers, whatever the corpus
    for r in found:
        table[r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] += np.frombuffer(r["sums"]).reshape(_BLOCK, -1)
    return table


def word_vectors(table: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Unit context vectors with the word's own index vector mixed in, and word weights
    that fall with frequency."""
    places, signs = _index_vectors(s)
    v, counts = table[:, :-1].copy(), table[:, -1]
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    np.add.at(v, (np.arange(s.buckets)[:, None], places), 0.5 * signs)
    share = counts / max(1.0, counts.sum())
    return v.astype(np.float32), (1e-2 / (1e-2 + share)).astype(np.float32)


def features(docs: DataFrame, table: np.ndarray, s: Settings) -> DataFrame:
    """doc_id and 2 x dims + 3 pooled numbers (float32 bytes) of every row."""
    vectors, weights = word_vectors(table, s)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, weights))  # buckets x dims float32

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, w = shared.value
        for batch in batches:
            ids, texts = batch.column(0), byte_values(batch.column(1))
            for lo, hi in runs(texts, 1 << 18):
                t, n = _tokens(texts[lo:hi], s.buckets)
                out = np.zeros((hi - lo, 2 * s.dims + 3), np.float32)
                out[:, -1] = np.log1p(n)
                full = n > 0
                if len(t):
                    starts = (np.cumsum(n) - n)[full]
                    weight = w[t][:, None]
                    x = v[t]
                    total = np.add.reduceat(weight, starts, axis=0)
                    weighted = x * weight
                    mean = np.add.reduceat(weighted, starts, axis=0) / total
                    np.multiply(x, x, out=weighted)
                    weighted *= weight
                    square = np.add.reduceat(weighted, starts, axis=0) / total
                    out[full, : 2 * s.dims] = np.hstack((mean, np.sqrt(np.maximum(square - mean * mean, 0))))
                    doc = np.repeat(np.arange(hi - lo), n)
                    for gap in (1, 2):
                        alike = np.zeros(len(t), np.float32)
                        alike[gap:] = np.einsum("ij,ij->i", x[gap:], x[:-gap]) * (doc[gap:] == doc[:-gap])
                        out[full, 2 * s.dims + gap - 1] = np.add.reduceat(alike, starts) / n[full]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array([o.tobytes() for o in out], pa.binary())], ["doc_id", "x"]
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, x binary")


class Net:
    """Two layers, tanh between them, trained with Adam; probabilities by temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray, s: Settings):
        r = np.random.default_rng(s.seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.p = [
            r.normal(0, x.shape[1] ** -0.5, (x.shape[1], s.hidden)), np.zeros(s.hidden),
            r.normal(0, s.hidden**-0.5, s.hidden), np.zeros(1),
        ]
        self.temperature = 1.0
        fit, own = (x[~apart], y[~apart]) if (~apart).any() else (x, y)
        z = (fit - self.mean) / self.scale
        m, v, step = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p], 0
        for _ in range(s.epochs):
            for rows in np.array_split(r.permutation(len(z)), max(1, len(z) // 128)):
                step += 1
                for k, g in enumerate(self._gradients(z[rows], own[rows])):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        if apart.any():
            logits, sign = self.logits(x[apart]), 2 * y[apart] - 1
            grid = np.exp(np.linspace(-1.5, 2.5, 161))
            self.temperature = float(grid[np.argmin([np.logaddexp(0, -sign * logits / t).mean() for t in grid])])

    def _gradients(self, z, y):
        w1, b1, w2, b2 = self.p
        h = np.tanh(z @ w1 + b1)
        d = (1 / (1 + np.exp(-(h @ w2 + b2))) - y) / len(z)
        back = np.outer(d, w2) * (1 - h * h)
        return z.T @ back + 1e-4 * w1, back.sum(axis=0), h.T @ d + 1e-4 * w2, np.array([d.sum()])

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.p
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def train(rows: DataFrame, s: Settings) -> Net | None:
    """A network from the rows of (doc_id, x, y), or, where they are more than ``max_train``,
    from those whose hash falls under that share; None without any row."""
    n = rows.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    # sorted here, as the order of rows must not depend on partitions
    sample = sorted(rows.filter(place * n < F.lit(s.max_train << 30)).collect(), key=lambda r: (r["doc_id"], bytes(r["x"])))
    if not sample:
        return None
    x = np.array([np.frombuffer(r["x"], np.float32) for r in sample], np.float64)
    apart = np.array([zlib.crc32(f"c{r['doc_id']}".encode()) % 5 == 0 for r in sample])
    return Net(x, np.array([float(r["y"]) for r in sample]), apart, s)


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, s: Settings = Settings()
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text, ...).

    ``labels`` (doc_id, quality, ...) are learned from rows whose crc32(doc_id as text) mod 4 is
    not 2. Only the text enters a score.

    Null and empty texts have the features zero and are scored like others. A null doc_id is
    kept (held_out false) and never trained on; null qualities are left out. Repeated
    ids: each row is scored; several labels of an id count by their mean. Without any
    label the score is 0.5 and predicted 0. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    x = written(features(docs, word_table(docs, s), s), "features", 1000)
    y = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("double").alias("y")).dropna()
    y = y.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).groupBy("doc_id").agg(F.avg("y").alias("y"))
    net = train(x.join(y, "doc_id"), s)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.array([np.frombuffer(v.as_buffer(), np.float32) for v in batch.column(1)], np.float64)
            score = net.scores(m) if net and len(m) else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    out = x.mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return out.select(
        "doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )
