"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

A document's set holds the hashes of its distinct 5-word shingles. Two keyed
bijections make the whole signature: the first spreads the shingles over 2**32
places, the second, shifted circularly by k, gives coordinate k. Documents that
agree on all rows of a band meet in a bucket. Buckets are verified on full sets: small ones
throughout, large ones from leaders outward, until every pair of a bucket is
either in one component or was compared. A large group of near copies so costs a
few stars, not all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import (
    bit_filter, byte_values, hash_words, in_filter, mix64, odd_constants, released, windows, written,
)
from quire.llm.components import connected_components

SHINGLE, ROWS, MISS, SEED = 5, 8, 1e-6, 20_011
#: Buckets up to this size are compared throughout at once: at most SMALL - 1 pairs a member.
SMALL = 8
PARTS = 64
_BATCH = 1000  # rows with texts or sets that a Python worker gets at a time
_RUN = 1 << 16  # shingles worked on at once: the working arrays stay in cache


def shingle_set(text: bytes, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; a text of 1 to n-1 words is one shingle."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    mult = odd_constants(n + 1, 5)
    h = hash_words(words)
    if len(h) < n:
        parts = np.append(h, np.uint64(len(h))) * np.append(mult[: len(h)], mult[n])
        return mix64(parts.sum(dtype=np.uint64, keepdims=True))
    return np.unique(windows(h, n, mult))


def _place(x: np.ndarray, seed: int) -> np.ndarray:
    """The first permutation: where a shingle stands on the circle of 2**32 places."""
    return (mix64(x ^ np.uint64(seed)) >> np.uint64(32)).astype(np.uint32)


def _second(x: np.ndarray, scratch: np.ndarray) -> None:
    """The second permutation, a bijection of 32-bit integers, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, None)):
        np.right_shift(x, np.uint32(shift), out=scratch)
        np.bitwise_xor(x, scratch, out=x)
        if factor:
            np.multiply(x, np.uint32(factor), out=x)


def circulant_signatures(sets: list[np.ndarray], coordinates: int, seed: int = SEED) -> np.ndarray:
    """One row of ``coordinates`` minima for each (non-empty) set."""
    out = np.empty((len(sets), coordinates), np.uint32)
    lo = 0
    while lo < len(sets):
        hi, size = lo, 0
        while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= _RUN):
            size += len(sets[hi])
            hi += 1
        places = _place(np.concatenate(sets[lo:hi]), seed)
        starts = np.cumsum([0] + [len(s) for s in sets[lo : hi - 1]])
        x, scratch = np.empty_like(places), np.empty_like(places)
        for k in range(coordinates):
            np.add(places, np.uint32((k * 0x9E3779B1 + seed) & 0xFFFFFFFF), out=x)
            _second(x, scratch)
            out[lo:hi, k] = np.minimum.reduceat(x, starts)
        lo = hi
    return out


def _band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    mult = odd_constants(rows, 77)
    s = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    key = (s * mult).sum(axis=2, dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * mult[0]
    return mix64(key).view(np.int64)


def signatures(docs: DataFrame, bands: int, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """doc_id, n_shingles, fp (128-bit fingerprint of the set) and the band keys."""

    @released
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), byte_values(batch.column(1))
            for lo in range(0, len(texts), 512):
                sets = [shingle_set(t) for t in texts[lo : lo + 512]]
                full = [s for s in sets if len(s)]
                keys = iter(_band_keys(circulant_signatures(full, bands * rows, seed), bands, rows).tolist() if full else [])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, 512),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "fp", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign, "doc_id long, n_shingles long, fp binary, bands array<long>"
    )


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, set) of the documents in ``nodes``: a scan that drops strangers early by a
    bitmap of fixed size, then an exact join."""
    bits = bit_filter(nodes, F.xxhash64(F.col("node").cast("long")))

    @released
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(bits, batch.column(2).to_numpy())))
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                sets = [shingle_set(t).tobytes() for t in byte_values(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["node", "set"])

    d = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text")
    ).withColumn("h", F.xxhash64("node"))
    return d.mapInArrow(build, "node long, set binary").join(nodes, "node", "left_semi")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) with 100 * |intersection| >= percent * |union|, on full sets."""

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                small, large = sorted((len(x), len(y)))
                if 100 * small < percent * large or not small:
                    keep.append(False)
                    continue
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("node").alias("u"), F.col("set").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("set").alias("sv"))
    return pairs.join(b, "v").join(a, "u").select("u", "v", "su", "sv").mapInArrow(compare, "u long, v long")


def _sharable(sets: DataFrame) -> DataFrame:
    """(node, size, shared, parts): shingles of each set, how many of them another set has too,
    and these by part of the hash space. Two sets share no more than the lesser number
    of each part, added up."""

    @released
    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                x = [np.frombuffer(v.as_buffer(), np.int64) for v in part.column(1)]
                nodes = np.repeat(part.column(0).to_numpy(), [len(v) for v in x])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(x))], ["node", "shingle"])

    rows = sets.select("node", "set").mapInArrow(unfold, "node long, shingle long")
    # a row for each shingle, so that the parts can be counted without its holders
    held = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("top"))
    part = F.col("shingle").bitwiseAND(F.lit(PARTS - 1)).cast("int")
    alone = held.filter("node = top").groupBy("node", part.alias("part")).agg(F.count("*").cast("int").alias("n"))
    alone = alone.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("alone"))
    # what an id with several sets holds alone cannot be told apart by set: its sets keep all
    alone = alone.join(sets.groupBy("node").agg(F.count("*").alias("k")).filter("k > 1"), "node", "left_anti")

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.frombuffer(v.as_buffer(), np.uint64) & np.uint64(PARTS - 1) for v in batch.column(1)]
            n = [np.bincount(v.astype(np.int64), minlength=PARTS).astype(np.int32) for v in x]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.list_(pa.int32()))], ["node", "all"])

    every = sets.select("node", "set").mapInArrow(count, "node long, all array<int>").join(alone, "node", "left")
    of_part = lambda n, i: n - F.coalesce(F.col("alone")[i], F.lit(0))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, n: s + n)
    return every.select("node", total("all").alias("size"), F.transform("all", of_part).alias("parts")).withColumn("shared", total("parts"))


def _pairs(heads: DataFrame, members: DataFrame, percent: int, label: bool = False) -> DataFrame:
    """Distinct pairs (u < v) of a bucket's heads with its members (of another label), as far
    as what they can share may suffice for a link."""
    h = heads.select("key", F.col("node").alias("x"), *[F.col(c).alias(f"{c}_x") for c in heads.columns if c not in ("key", "node")])
    need = percent * (F.col("size") + F.col("size_x"))
    common = F.aggregate(F.zip_with("parts", "parts_x", lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda s, n: s + n)
    may = (F.col("x") != F.col("node")) & ((100 + percent) * F.least("shared", "shared_x") >= need)
    may = may & (F.col("label") != F.col("label_x")) if label else may
    both = h.join(members, "key").filter(F.when(may, (100 + percent) * common >= need).otherwise(False))
    return both.select(F.least("x", "node").alias("u"), F.greatest("x", "node").alias("v")).distinct()


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands needed so that a pair at the threshold meets in none with probability ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _leaders(members: DataFrame, fan: int) -> DataFrame:
    """Up to ``fan`` members of each bucket: the least of each salt, by partial aggregates."""
    return members.groupBy("key", F.pmod(F.xxhash64("node"), F.lit(fan)).alias("salt")).agg(
        F.min("node").alias("node")
    ).select("key", "node")


def near_duplicates(
    docs: DataFrame, percent: int = 85, rows: int = ROWS, miss: float = MISS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text, ...).

    Links join documents whose 5-word shingle sets (A-Z lower-cased) have a Jaccard
    similarity of at least ``percent``/100. ``component_id`` is the smallest doc_id that
    can be reached, ``kept`` marks it.

    Null, empty and blank texts have an empty set and are linked with nothing. A null
    doc_id is linked with nothing, its component_id is null and kept is false. Rows
    that share a doc_id count as one document: it is linked with what any of its rows is
    linked with, and each row is returned. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    sig = written(signatures(docs, bands_for(percent, rows, miss), rows, seed), "sig", _BATCH)
    known = sig.filter("n_shingles > 0 and doc_id is not null")
    # one representative for each distinct set: copies never meet in a bucket
    rep = known.groupBy("fp").agg(F.min(F.struct("doc_id", "bands")).alias("r"))
    spread = rep.select(F.explode("r.bands").alias("key"), F.col("r.doc_id").alias("node"))
    sizes = spread.groupBy("key").agg(
        F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("top")
    ).filter("least < top").select("key")
    buckets = written(spread.join(sizes, "key"), "buckets")
    sets = written(_sets_of(docs, buckets.select("node").distinct()), "sets", _BATCH)
    # a set with too much that no other candidate has cannot be linked
    able = written(_sharable(sets).filter(100 * F.col("shared") >= percent * F.col("size")), "sizes", _BATCH)
    buckets = buckets.join(able, "node")
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = written(buckets.join(sizes, "key"), "able", _BATCH)

    # small buckets are compared throughout, large ones from some leaders
    small, large = buckets.filter(F.col("n") <= SMALL).drop("n"), buckets.filter(F.col("n") > SMALL).drop("n")
    led = written(_leaders(large, SMALL), "leaders")
    heads = small.unionByName(large.join(led, ["key", "node"], "left_semi"))
    pairs = written(_pairs(heads, buckets.drop("n"), percent), "pairs")
    links = written(_linked(pairs, sets, percent), "links", _BATCH)
    labels = written(connected_components(links), "labels")
    checked, fan = pairs, SMALL
    # a row for each member, not for each of its buckets: labels are joined to it in every round
    member = written(large.groupBy("node").agg(F.collect_set("key").alias("keys")), "members")
    while True:
        # members of large buckets that are in another component than most, and led by none yet
        lab = member.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        lab = lab.select(F.explode("keys").alias("key"), "node", "label")
        counts = lab.groupBy("key", "label").agg(F.count("*").alias("n"))
        main = counts.groupBy("key").agg(F.max(F.struct("n", "label")).alias("m"), F.count("*").alias("k"))
        lab = written(lab.join(main.filter("k > 1").select("key", F.col("m.label").alias("main")), "key"), "open")
        fan *= 8
        new = lab.filter("label <> main").select("key", "node").join(led, ["key", "node"], "left_anti")
        new = written(_leaders(new, fan), "leaders")
        if new.isEmpty():
            break
        led = led.unionByName(new)
        lab = lab.drop("main").join(able, "node")
        more = _pairs(lab.join(new, ["key", "node"], "left_semi"), lab, percent, label=True)
        more = written(more.join(checked, ["u", "v"], "left_anti"), "pairs")
        found = written(_linked(more, sets, percent), "links", _BATCH)
        checked = checked.unionByName(more)
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = written(connected_components(links), "labels")

    # the label of a set's representative, for all rows with that set
    of_set = rep.select("fp", F.col("r.doc_id").alias("node"))
    repeated = known.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a <> b")
    if not repeated.isEmpty():  # an id with rows of several sets ties these sets together
        ties = known.join(repeated, "doc_id", "left_semi").join(of_set, "fp")
        ties = ties.select(F.col("doc_id").alias("u"), F.col("node").alias("v")).filter("u <> v")
        labels = written(connected_components(links.unionByName(ties)), "labels")
    of_set = of_set.join(labels, "node", "left").select("fp", F.coalesce("label", "node").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", "fp").join(of_set, "fp", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", comp.alias("component_id"),
        F.coalesce(F.col("doc_id") == comp, F.lit(False)).alias("kept"),
    )
