"""Training-order materialisation: token sequences written in a keyed random order.

Documents are tokenised once; their tokens, each document closed by an end token, form one
stream that is cut into sequences of equal length. A keyed Feistel network over the next power of
four, walked until it falls inside, is a permutation of the sequence numbers: it gives every
sequence its global slot without a shuffle of indexes or a table. Shard k holds the slots of
one range in order, each with the same number of bytes, so any slot can be sought and
a reader can go on where it stopped.

The stream's order is that of the token table, which is written once: retried tasks and later reads see the
same order. Shards are written by Spark's text writer, whose separator is the guard word after each sequence.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.llm.common import mix64

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH, SLOTS = 2048, 4096
GUARD = "end\n"
_ROUNDS = 6


class Feistel:
    """A keyed permutation of 0 .. n-1."""

    def __init__(self, n: int, key: int):
        if n < 1:
            raise ValueError("n must be positive")
        self.n, self.half = n, np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        with np.errstate(over="ignore"):
            self.keys = mix64(np.arange(1, _ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (1 << 64) - 1))

    def _once(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        a, b = x >> self.half, x & self.mask
        for k in keys:
            if back:
                a, b = b ^ (mix64(a ^ k) & self.mask), a
            else:
                a, b = b, a ^ (mix64(b ^ k) & self.mask)
        return a << self.half | b

    def _walk(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        y = self._once(np.array(x, np.uint64), keys, back)
        while (out := y >= np.uint64(self.n)).any():
            y[out] = self._once(y[out], keys, back)
        return y.astype(np.int64)

    def slot(self, sequence: np.ndarray) -> np.ndarray:
        return self._walk(sequence, self.keys, False)

    def sequence(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self.keys[::-1], True)


@lru_cache(maxsize=2)
def tokenizer(ranks_file: str, pattern: str = PATTERN):
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokenised(docs: DataFrame, ranks_file: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """part, start, n, ids: each document's tokens (2 bytes each) with the end token, and where
    they stand in the stream of their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = tokenizer(ranks_file, pattern), 0
        end = len(enc._mergeable_ranks)
        if end >= 1 << 16:
            raise ValueError("ids and the end token must fit 2 bytes")
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [np.array([*enc.encode_ordinary(t or ""), end], "<u2") for t in part.column(1).to_pylist()]
                n = np.array([len(x) for x in ids], np.int64)
                starts = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(starts), pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())],
                    ["doc_id", "part", "start", "n", "ids"],
                )

    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.spark_partition_id())
    return d.mapInArrow(run, "doc_id long, part int, start long, n long, ids binary")


def _pieces(tokens: DataFrame, base: dict[int, int], feistel: Feistel, length: int) -> DataFrame:
    """slot, at, data: the stream cut at sequence borders; data is compressed for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=9).compress
        for batch in batches:
            part, start, n = (batch.column(k).to_numpy() for k in (0, 1, 2))
            if not len(part):
                continue
            # neighbouring rows of one partition are one stretch of the stream
            new = np.concatenate(([True], (part[1:] != part[:-1]) | (start[1:] != start[:-1] + n[:-1])))
            edges = np.append(np.flatnonzero(new), len(part))
            for a, b in zip(edges, edges[1:]):
                data = b"".join(batch.column(3).slice(a, b - a).to_pylist())
                lo = base[int(part[a])] + int(start[a])
                hi = lo + len(data) // 2
                first = np.arange(lo // length, (hi - 1) // length + 1)
                begins, ends = np.maximum(first * length, lo), np.minimum((first + 1) * length, hi)
                for k in range(0, len(first), 2048):
                    cut = [data[2 * (x - lo) : 2 * (y - lo)] for x, y in zip(begins[k : k + 2048].tolist(), ends[k : k + 2048].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(feistel.slot(first[k : k + 2048])), pa.array(begins[k : k + 2048] % length), pa.array(map(pack, cut), pa.binary())],
                        ["slot", "at", "data"],
                    )

    return tokens.select("part", "start", "n", "ids").mapInArrow(run, "slot long, at long, data binary")


def _assembled(pieces: DataFrame, length: int, pad: int) -> DataFrame:
    """value: the sequences in slot order, from pieces sorted by slot and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, held, now = zstandard.ZstdDecompressor().decompress, [], None
        filler = np.full(length, pad, "<u2").tobytes()

        def done() -> bytes:
            row = b"".join(held)
            return row + filler[len(row) :]  # only the last sequence is short

        for batch in batches:
            out, shards = [], []
            for shard, slot, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if now is not None and now[1] != slot:
                    out.append(done())
                    shards.append(now[0])
                    held.clear()
                now = (shard, slot)
                held.append(unpack(data))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(out, pa.binary())], ["shard", "value"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([done()], pa.binary())], ["shard", "value"])

    return pieces.select("shard", "slot", "data").mapInArrow(run, "shard long, value binary")


def write_training_order(
    docs: DataFrame, path: str, key: int = 1234, length: int = LENGTH, slots: int = SLOTS,
    ranks_file: str = RANKS, pattern: str = PATTERN,
) -> dict:
    """Writes ``path``/tokens (the token table) and ``path``/shards (shard=k folders with one file
    each) and returns the layout: sequences, tokens, length, slots, stride (bytes), key.

    ``slots`` is the number of sequences of a shard; a task writes one shard. ``docs`` has doc_id
    and text. Null and empty texts are an end token alone; null and repeated ids are kept;
    other columns are ignored, whatever their names. The last sequence is filled up with
    end tokens. An empty table writes no shard.
    """
    spark = docs.sparkSession
    tokenised(docs, ranks_file, pattern).write.options(**{"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}).parquet(f"{path}/tokens")
    tokens = spark.read.parquet(f"{path}/tokens")
    sums = tokens.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # a row per scan task
    base, total = {}, 0
    for r in sums:
        base[r["part"]] = total
        total += r["n"]
    layout = {"sequences": -(-total // length), "tokens": total, "length": length, "slots": slots,
              "stride": 2 * length + len(GUARD), "key": key}
    if total:
        pad = len(tokenizer(ranks_file, pattern)._mergeable_ranks)
        pieces = _pieces(tokens, base, Feistel(layout["sequences"], key), length)
        pieces = pieces.withColumn("shard", F.expr(f"slot div {slots}"))
        pieces = pieces.repartitionById(-(-layout["sequences"] // slots), F.col("shard").cast("int"))
        rows = _assembled(pieces.sortWithinPartitions("slot", "at"), length, pad)
        rows.select("shard", F.col("value").cast("string").alias("value")).write.partitionBy("shard").text(f"{path}/shards", lineSep=GUARD)
    return layout


def read_training_order(spark: SparkSession, path: str, layout: dict, first_slot: int = 0) -> DataFrame:
    """slot, shard, offset, sequence, n_tokens and ids (2 bytes each) from ``first_slot`` on. Shards before
    it are not opened. A shard of another size than the layout says fails the job."""
    schema = "slot long, shard long, offset long, sequence long, n_tokens long, ids binary"
    if not layout["sequences"]:
        return spark.createDataFrame([], schema)
    feistel, stride, slots = Feistel(layout["sequences"], layout["key"]), layout["stride"], layout["slots"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = memoryview(content.as_buffer())
                n = min(slots, layout["sequences"] - shard * slots)
                if len(raw) != n * stride:
                    raise ValueError(f"shard {shard} has {len(raw)} bytes, not {n * stride}")
                for lo in range(max(0, first_slot - shard * slots), n, 1024):
                    k = np.arange(lo, min(n, lo + 1024))
                    slot = shard * slots + k
                    seq = feistel.sequence(slot)
                    left = np.minimum(layout["tokens"] - seq * layout["length"], layout["length"])
                    ids = []
                    for i, m in zip(k.tolist(), left.tolist()):
                        if raw[(i + 1) * stride - len(GUARD) : (i + 1) * stride] != GUARD.encode():
                            raise ValueError(f"shard {shard} has no guard word after slot {i}")
                        ids.append(bytes(raw[i * stride : i * stride + 2 * m]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slot), pa.array(np.full(len(k), shard)), pa.array(k * stride), pa.array(seq), pa.array(left), pa.array(ids, pa.binary())],
                        ["slot", "shard", "offset", "sequence", "n_tokens", "ids"],
                    )

    files = spark.read.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary, shard long").load(f"{path}/shards")
    files = files.filter(F.col("shard") >= first_slot // slots)
    return files.select("shard", "content").mapInArrow(run, schema)
