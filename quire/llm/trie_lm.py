"""Language-model scoring with an Elias-Fano n-gram trie.

Documents are packed in runs of a few megabytes, as numbers of their distinct words. Runs tell hash buckets their
distinct n-grams, bigrams first, then trigrams; a bucket counts each n-gram and the kinds of words that follow each
context, and replies. So every n-gram of the training documents counts. Probabilities are Witten-Bell smoothed.

The n-grams whose count is at least 1/``entries`` of all training tokens, at most ``entries`` a level whatever the
corpus, make up the trie: one file with quantised probabilities, handed to the executors and memory-mapped. What is not in it is
worked out from the buckets' replies.

A bucket has all followers of its contexts. Those of contexts that would fill an eighth of a bucket are dealt out
over all buckets, and the kinds of their followers added up. A trigram whose context occurs once, in a training document, needs no
bucket: it has the only follower of its context.

Words are told apart by 64-bit hashes. N-grams are by 48 bits of the context's hash and 48 of the last word's, inside buckets
that other bits give.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import (
    batch_rows, byte_values, dealt, hash_words, mix64, odd_constants, put_file, released, runs, shuffles_freed, written,
)
from quire.llm.elias_fano import Trie, write_trie

END = b"\x20"  # the end token; no word is a space
ORDER = 3
#: A word or n-gram with fewer than 1/ENTRIES of the training tokens is not in the table
#: or trie, but with the buckets. A trie's words have at least 1/WORDS.
ENTRIES, WORDS = 1 << 20, 1 << 17
_SHIFT = 20
_PACK = 4 << 20  # bytes of text in a run
_BUCKET = 8 << 20  # bytes of text behind a bucket
_ROWS = 2  # runs that a Python worker gets at a time
_PARTS = odd_constants(2, 67)
_ASKED = "run long, bucket long, heads binary, sizes binary, common binary, words binary, said binary"
_REPLY = "run long, bucket long, grams binary, kinds binary, totals binary"


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _token_lists(texts: list[bytes]) -> list[list[bytes]]:
    return [[*t.lower().split(), END] for t in texts]


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c over the training documents (doc_id, text), with the end token."""

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = [not held_out(i) for i in batch.column(0).to_pylist()]
            texts = [t for t, use in zip(byte_values(batch.column(1)), train) if use]
            for lo, hi in runs(texts, 8 << 20):
                c: Counter = Counter()
                for t in texts[lo:hi]:
                    c.update(t.lower().split())
                c[END] += hi - lo
                words, n = list(c), list(c.values())
                for at in range(0, len(words), 20_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(words[at : at + 20_000], pa.binary()), pa.array(n[at : at + 20_000], pa.int64())], ["word", "c"]
                    )

    return docs.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Table:
    """Words frequent enough for the tasks, most frequent first; the first ``n_trie`` are
    words of the trie, their places its ids."""

    ids: dict
    counts: np.ndarray
    n_trie: int
    tokens: int
    distinct: int

    def log_base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def frequent(vocabulary: DataFrame, entries: int, words: int) -> Table:
    total = vocabulary.agg(F.sum("c"), F.count("*")).first()
    tokens, distinct = total[0] or 0, total[1]
    often = (F.col("c") * entries >= tokens) | (F.col("word") == F.lit(END))
    rows = vocabulary.filter(often).toPandas()  # at most ``entries`` rows and the end token
    rows["word"] = rows["word"].map(bytes)
    rows = rows.sort_values(["c", "word"], ascending=[False, True])
    counts = rows["c"].to_numpy(np.int64)
    return Table(dict(zip(rows["word"], range(len(rows)))), counts, int((counts * words >= max(tokens, 1)).sum()), tokens, distinct)


@lru_cache(maxsize=1)
def _zstd() -> tuple:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _planes(a: np.ndarray) -> bytes:
    """Counts as their lowest bytes, then the next ones and so on, as many as the largest needs; compressed."""
    if not len(a):
        return b""
    width = max(1, -(-int(a.max()).bit_length() // 8))
    flat = np.ascontiguousarray(a.astype(np.int64).view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + _zstd()[0].compress(flat.tobytes())


def _unplaned(b: bytes) -> np.ndarray:
    if not b:
        return np.empty(0, np.int64)
    flat = np.frombuffer(_zstd()[1].decompress(b[1:]), np.uint8).reshape(b[0], -1)
    out = np.zeros((flat.shape[1], 8), np.uint8)
    out[:, : b[0]] = flat.T
    return out.view(np.int64).ravel()


def _low(a: np.ndarray, width: int) -> np.ndarray:
    return a & np.uint64((1 << 8 * width) - 1)


def _bytes(a: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bytes of each hash."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _hashes(b: pa.BinaryScalar, width: int) -> np.ndarray:
    got = np.frombuffer(b.as_buffer(), np.uint8).reshape(-1, width)
    out = np.zeros((len(got), 8), np.uint8)
    out[:, :width] = got
    return out.view(np.uint64).ravel()


def _gram(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of the n-gram of a context and a word, by their hashes."""
    return mix64(head * _PARTS[0] + _low(word, 6) * _PARTS[1])


def _joined(parts: list, kind=np.int64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _pack(docs: DataFrame) -> DataFrame:
    """(n_bytes, ids, sizes, words, tokens, run): runs of documents; hashes of a run's distinct words, and the number of each
    token's word. A document is never cut."""

    @released
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_values(batch.column(1))
            for lo, hi in runs(texts, _PACK):
                lists = _token_lists(texts[lo:hi])
                coded = pa.array([w for ws in lists for w in ws], pa.large_binary()).dictionary_encode()
                yield pa.RecordBatch.from_arrays([
                    pa.array([sum(map(len, texts[lo:hi]))], pa.int64()),
                    pa.array([batch.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                    pa.array([list(map(len, lists))], pa.list_(pa.int64())),
                    pa.array([hash_words(coded.dictionary.to_numpy(zero_copy_only=False).tolist()).tobytes()], pa.binary()),
                    pa.array([_planes(coded.indices.to_numpy())], pa.binary()),
                ], ["n_bytes", "ids", "sizes", "words", "tokens"])

    packed = docs.mapInArrow(pack, "n_bytes long, ids array<long>, sizes array<long>, words binary, tokens binary")
    return packed.withColumn("run", F.monotonically_increasing_id())


def _distinct(head: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of two numbers below 2**31, sorted, and for each place which of them it has."""
    n = len(head)
    places, bits = n.bit_length(), int(word.max(initial=0)).bit_length()
    key = head << bits | word
    if int(key.max(initial=0)).bit_length() + places < 64:  # sorted with their places, faster than places by pairs
        key = np.sort(key << places | np.arange(n))
        at, key = key & ((1 << places) - 1), key >> places
    else:
        at = np.argsort(key)
        key = key[at]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    code = np.empty(n, np.int64)
    code[at] = np.cumsum(new) - 1
    key = key[new]
    return key >> bits, key & ((1 << bits) - 1), code


class _Asked:
    """The distinct n-grams of a run in the order in which it tells them: by bucket, then by context. ``head`` and
    ``word`` number each n-gram's context and last word, whose hashes are in ``contexts`` and ``words``. ``width``: bytes of a
    context's hash that are told."""

    def __init__(self, head, word, contexts, common, words, buckets: int, width: int):
        h, last, code = _distinct(head, word)
        self.buckets, self.width = buckets, width
        follow, deal = words[last], contexts
        contexts = _low(contexts, width) if width < 8 else contexts
        gram = _gram(contexts[h], follow)
        # by the highest bits
        bucket = ((np.where(common[h], gram, deal[h]) >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
        # pairs are sorted by context; numbers of 16 bits are sorted by radix
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        self.number = number[code]  # of each place's n-gram
        self.gram, self.word, self.bucket, h = gram[order], follow[order], bucket[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (self.bucket[1:] != self.bucket[:-1])
        self.starts = np.flatnonzero(new)
        self.heads, self.stretch = h[self.starts], np.cumsum(new) - 1
        self.contexts, self.common = contexts[self.heads], common[self.heads]

    def rows(self, run: int, train: np.ndarray) -> pa.RecordBatch:
        """What each bucket is told: contexts, with how many n-grams each, their last words, and twice their count
        in training documents, and one more if others hold them."""
        n = len(self.gram)
        said = 2 * np.bincount(self.number, train, n).astype(np.int64) + (np.bincount(self.number, ~train, n) > 0)
        sizes = np.diff(np.append(self.starts, n))
        cuts = np.searchsorted(self.bucket, np.arange(self.buckets + 1))
        heads = np.searchsorted(self.starts, cuts)
        out = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            lo, hi, x, y = cuts[b], cuts[b + 1], heads[b], heads[b + 1]
            out.append((run, b, _bytes(self.contexts[x:y], self.width), _planes(sizes[x:y]), self.common[x:y].tobytes(),
                        _bytes(self.word[lo:hi], 6), _planes(said[lo:hi])))
        columns = list(zip(*out)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["run", "bucket", "heads", "sizes", "common", "words", "said"])


def _counting(tokens: int, entries: int, width: int):
    """What a bucket does: replies to its runs, and a row without run that has the frequent n-grams, and the
    kinds of followers of common and of frequent contexts that it knows of."""

    def count(t: pa.Table) -> pa.Table:
        heads, words = [_hashes(b, width) for b in t.column("heads")], [_hashes(b, 6) for b in t.column("words")]
        said, sizes = (_joined([_unplaned(b.as_py()) for b in t.column(x)]) for x in ("said", "sizes"))
        common = _joined([np.frombuffer(b.as_buffer(), bool) for b in t.column("common")], bool)
        context, word = _joined(heads, np.uint64), _joined(words, np.uint64)
        owner = np.repeat(np.arange(len(context)), sizes)
        code, unique = pd.factorize(_gram(context[owner], word))
        c = np.bincount(code, said >> 1, len(unique)).astype(np.int64)
        held = np.bincount(code, said & 1, len(unique)) > 0
        head, distinct = pd.factorize(context)
        one = np.empty(len(unique), np.int64)
        one[code] = np.arange(len(code))  # a place of each n-gram
        of = head[owner[one]]
        kinds = np.bincount(of, c > 0, len(distinct)).astype(np.int64)
        total = np.bincount(of, c, len(distinct)).astype(np.int64)
        reply, out = 2 * c + held, []
        own_total = np.where(common, 0, total[head])  # those of common contexts are known
        at, to = np.cumsum([0, *map(len, words)]), np.cumsum([0, *map(len, heads)])
        for k, (run, bucket) in enumerate(zip(t.column("run").to_pylist(), t.column("bucket").to_pylist())):
            own = slice(to[k], to[k + 1])
            out.append((run, bucket, _planes(reply[code[at[k] : at[k + 1]]]), _planes(kinds[head[own]]),
                        _planes(own_total[own]) if width == 8 else b""))
        often = np.flatnonzero((c > 0) & (c * entries >= tokens))
        told = (total > 0) & (total * entries >= tokens)
        told[head[common]] = True
        dealt = np.flatnonzero(told)
        rows = np.concatenate((context[owner[one[often]]].view(np.int64), word[one[often]].view(np.int64), c[often]))
        out.append((-1, bucket, rows.tobytes(), np.concatenate((distinct[dealt].view(np.int64), kinds[dealt])).tobytes(), b""))
        return pa.table([pa.array(x, y) for x, y in zip(zip(*out), [pa.int64(), pa.int64(), *[pa.binary()] * 3])],
                        ["run", "bucket", "grams", "kinds", "totals"])

    return count


def _replies(asked: DataFrame, tokens: int, entries: int, width: int, name: str) -> tuple[DataFrame, np.ndarray, tuple]:
    """For each run what its buckets replied; the frequent n-grams (hash of the context and of the word, count); the hashes
    of common and of frequent contexts, sorted, with the kinds of their followers."""
    with shuffles_freed(asked.sparkSession):  # asked n-grams and runs that have met replies
        replies = written(asked.groupBy("bucket").applyInArrow(_counting(tokens, entries, width), _REPLY), "counts")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.column(0).to_pylist():
                x = np.frombuffer(b, np.int64).reshape(2, -1)
                for at in range(0, x.shape[1], 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(y[at : at + 100_000]) for y in x], ["head", "kinds"])

    whole = replies.filter("run < 0")
    kinds = whole.select("kinds").mapInArrow(unpack, "head long, kinds long").groupBy("head").agg(F.sum("kinds").alias("kinds"))
    kinds = kinds.toPandas()  # common and frequent contexts only
    head, kinds = kinds["head"].to_numpy(np.int64).view(np.uint64), kinds["kinds"].to_numpy(np.int64)
    order = np.argsort(head)
    grams = [np.frombuffer(r[0], np.int64).reshape(3, -1) for r in whole.select("grams").collect()]  # frequent ones only
    grams = np.concatenate(grams, axis=1) if grams else np.empty((3, 0), np.int64)
    parts = F.sort_array(F.collect_list(F.struct("bucket", "grams", "kinds", "totals"))).alias(name)
    return replies.filter("run >= 0").groupBy("run").agg(parts), grams, (head[order], kinds[order])


def _place(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each asked value in sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


class _Run:
    """Tokens of a run of documents, with what the buckets replied for their n-grams."""

    def __init__(self, row: tuple, model: _Shared):
        self.ids, sizes, words, tokens = row[:4]
        self.words, self.token = np.frombuffer(words, np.uint64), _unplaned(tokens)
        place = _place(model.hashes, self.words)
        self.place = place = np.where(place >= 0, model.places[place] if len(model.places) else -1, -1)
        self.in_table, self.model = place[self.token], model
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.train = np.array([not held_out(i) for i in self.ids], bool)[self.doc]
        self.at = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1  # tokens with one before them
        common = np.zeros(len(place), bool)
        common[place >= 0] = model.common(model.counts[place[place >= 0]])
        self.two = _Asked(self.token[self.at - 1], self.token[self.at], self.words, common, self.words, model.buckets, 8)

    def _replied(self, asked: _Asked, parts, kinds: tuple) -> tuple:
        """By n-gram what was replied, and by stretch of n-grams with one context the kinds and the number of followers."""
        said, kind, total = (_joined([_unplaned(p[x]) for p in parts or []]) for x in ("grams", "kinds", "totals"))
        hit = np.flatnonzero(asked.common)
        kind[hit] = kinds[1][_place(kinds[0], asked.contexts[hit])] if len(hit) else 0
        return said, kind, total

    def counted(self, parts) -> None:
        """Takes the replies for bigrams. Counts of words: every word but the end token is a context."""
        m = self.model
        said, kinds, total = self._replied(self.two, parts, m.kinds[0])
        self.count = np.where(self.place >= 0, m.counts[self.place] if len(m.counts) else 0, 0)
        rare = self.place[self.two.heads] < 0
        self.count[self.two.heads[rare]] = total[rare]
        self.c2 = np.zeros(len(self.token), np.int64)
        self.k2, self.t2, alone = self.c2.copy(), self.c2.copy(), np.zeros(len(self.token), bool)
        number = self.two.number
        self.c2[self.at] = said[number] >> 1
        alone[self.at] = said[number] == 2  # once, in a training document
        self.k2[self.at], self.t2[self.at] = kinds[self.two.stretch[number]], self.count[self.token[self.at - 1]]
        place = np.zeros(len(self.token), np.int64)
        place[self.at] = number
        at = self.at[1:][self.at[1:] == self.at[:-1] + 1]  # tokens with two before them
        at = at[(self.doc[at] == self.doc[at - 2]) & (self.c2[at - 1] > 0)]
        self.single = at[alone[at - 1]]
        self.at3 = at[~alone[at - 1]]
        self.three = _Asked(
            place[self.at3 - 1], self.token[self.at3], self.two.gram, m.common(said >> 1), self.words, m.buckets, 6)

    def counted_three(self, parts) -> None:
        said, kinds, _ = self._replied(self.three, parts, self.model.kinds[1])
        self.c3 = np.zeros(len(self.token), np.int64)
        self.k3, self.t3 = self.c3.copy(), self.c3.copy()
        number = self.three.number
        self.c3[self.at3], self.k3[self.at3] = said[number] >> 1, kinds[self.three.stretch[number]]
        self.t3[self.at3] = self.c2[self.at3 - 1]
        self.c3[self.single] = self.k3[self.single] = self.t3[self.single] = 1


@dataclass
class _Shared:
    """What tasks need of the model beside the trie: hashes of the table's words, sorted, with their places; counts by place."""

    buckets: int
    tokens: int
    entries: int
    hashes: np.ndarray
    places: np.ndarray
    counts: np.ndarray
    kinds: list

    def frequent(self, c: np.ndarray) -> np.ndarray:
        """Whether n-grams of such counts may be in the trie."""
        return c * self.entries >= self.tokens

    def common(self, c: np.ndarray) -> np.ndarray:
        """Whether contexts of such counts are dealt out."""
        return c * min(self.entries, 8 * self.buckets) >= self.tokens


@dataclass
class Model:
    """The trie of the frequent n-grams, the words' back-off masses, and the runs with the counts of all their n-grams."""

    data: bytes
    back: np.ndarray
    runs: DataFrame
    shared: _Shared


def _smoothed(c: np.ndarray, kinds: np.ndarray, total: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Probabilities after contexts with ``total`` followers of so many kinds (none: that of the shorter context)."""
    return (c + kinds * short + (total == 0) * short) / (total + kinds + (total == 0))


def _level(key: np.ndarray, c: np.ndarray, above_keys: np.ndarray, above_counts: np.ndarray, kinds: np.ndarray, short: np.ndarray) -> dict:
    """Smoothed probabilities of the frequent n-grams, by key; ``kinds`` of the followers of the nodes above."""
    parent = np.searchsorted(above_keys, key >> _SHIFT)
    p = _smoothed(c, kinds[parent], above_counts[parent], short)
    back = np.where(kinds > 0, np.maximum(kinds, 1) / np.maximum(above_counts + kinds, 1), 1.0)
    return {
        "key": key, "c": c, "parent": parent, "word": key & ((1 << _SHIFT) - 1), "p": p, "log_p": np.log10(p),
        "back": np.log10(back), "above": len(above_keys),
    }


def model(docs: DataFrame, table: Table, order: int = ORDER, entries: int = ENTRIES) -> Model:
    """Counts all n-grams of the training documents and makes the trie of the frequent ones."""
    spark = docs.sparkSession
    packed = dealt(_pack(docs), "run", "runs", 4000)
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    found = packed.select("run", "ids", "sizes", "words", "tokens")
    hashes = hash_words(list(table.ids))  # by place
    by, n_trie = np.argsort(hashes), table.n_trie
    shared = _Shared(max(8, math.ceil(total / _BUCKET)), table.tokens, entries, hashes[by], by, table.counts, [])
    short_hashes = _low(hashes, 6)
    by_short = np.argsort(short_hashes)
    # nodes of the level above: the hashes of their n-grams, their keys and counts
    node, keys, counts = hashes[:n_trie], np.arange(n_trie), table.counts[:n_trie]
    p1, levels = 10 ** table.log_base(table.counts), []
    for n in range(2, order + 1):
        handed, width = spark.sparkContext.broadcast(shared), 8 if n == 2 else 6
        node = _low(node, 6) if n > 2 else node

        @released
        def ask(batches: Iterator[pa.RecordBatch], n=n, handed=handed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    run, *row = (x[i].as_py() for x in batch.columns)
                    r = _Run(row, handed.value)
                    if n == 2:
                        yield r.two.rows(run, r.train[r.at])
                    else:
                        r.counted(row[4])
                        yield r.three.rows(run, r.train[r.at3])

        with batch_rows(spark, _ROWS):
            replied, grams, kinds = _replies(found.mapInArrow(ask, _ASKED), table.tokens, entries, width, f"replies{n}")
        found = found.join(replied, "run", "left")
        shared = replace(shared, kinds=[*shared.kinds, kinds])
        at = _place(kinds[0], node)
        above = np.where(at >= 0, kinds[1][at] if len(kinds[1]) else 0, 0)
        order_of = np.argsort(node)
        parent, word = _place(node[order_of], grams[0].view(np.uint64)), _place(short_hashes[by_short], grams[1].view(np.uint64))
        ok = (parent >= 0) & (word >= 0)
        parent, word, c = order_of[parent[ok]], by_short[word[ok]], grams[2][ok]
        parent, word, c = parent[word < n_trie], word[word < n_trie], c[word < n_trie]
        key = keys[parent] << _SHIFT | word
        sort = np.argsort(key)
        key, c, parent, word = key[sort], c[sort], parent[sort], word[sort]
        if n == 2:
            short = p1[word]
        else:
            short = levels[-1]["p"][np.searchsorted(keys, key & ((1 << _SHIFT * (n - 1)) - 1))]
        levels.append(_level(key, c, keys, counts, above, short))
        node, keys, counts = _gram(node[parent], hashes[word]), key, c
    for upper, g in zip(levels, [*levels[1:], None]):
        upper["log_b"] = g["back"] if g else np.zeros(len(upper["key"]))
    return Model(write_trie(levels), levels[0]["back"].astype(np.float32), found, shared)


def build(docs: DataFrame, table: Table, order: int = ORDER, entries: int = ENTRIES) -> tuple[bytes, np.ndarray]:
    """The trie of the training documents, and the words' back-off masses."""
    m = model(docs, table, order, entries)
    return m.data, m.back


@lru_cache(maxsize=2)
def _mapped(name: str) -> Trie:
    return Trie(np.memmap(SparkFiles.get(name), np.uint8, "r"))


def _nodes(ids: np.ndarray, doc: np.ndarray, n_trie: int, trie: Trie, run: _Run | None = None) -> tuple[np.ndarray, ...]:
    """Each token's bigram and trigram in the trie (-1: none), the node of the two tokens before it, and whether the
    token before it is a word of the trie. By a ``run``'s counts only n-grams frequent enough for the trie are looked up."""
    in_trie = (ids >= 0) & (ids < n_trie)
    prior = np.concatenate(([-1], ids[:-1]))
    has = np.concatenate(([False], in_trie[:-1] & (doc[1:] == doc[:-1]))) if len(ids) else np.zeros(0, bool)
    # each distinct pair is looked up once
    two, node, three = (np.full(len(ids), -1) for _ in range(3))
    look = np.flatnonzero(has & in_trie & (True if run is None else run.model.frequent(run.c2)))
    head, word, code = _distinct(prior[look], ids[look])
    two[look] = trie.children(0, head, word)[code]
    if len(trie.levels) > 1 and len(ids):
        # the context's node is the bigram that ends at the token before
        node = np.concatenate(([-1], two[:-1]))
        node = np.where(has & (np.concatenate(([-1], doc[:-1])) == doc), node, -1)
        look = np.flatnonzero((node >= 0) & in_trie & (True if run is None else run.model.frequent(run.c3)))
        head, word, code = _distinct(node[look], ids[look])
        three[look] = trie.children(1, head, word)[code]
    return two, three, node, has


def _ngram_logs(
    ids: np.ndarray, doc: np.ndarray, base: np.ndarray, t: Table, trie: Trie, back: np.ndarray, run: _Run | None = None
) -> np.ndarray:
    """log10 probability of every token given up to two tokens before; ``base`` is that of
    the word alone. Without a ``run`` the trie's n-grams are all there are."""
    two, three, node, has = _nodes(ids, doc, t.n_trie, trie, run)
    log = base + np.where(has, back[np.where(has, ids[np.arange(len(ids)) - 1], 0)] if len(back) else 0.0, 0.0)
    if run is not None:  # bigrams and contexts that the trie has not
        rest = np.flatnonzero((two < 0) & (run.t2 > 0) & ((run.c2 > 0) | ~has))
        log[rest] = np.log10(_smoothed(run.c2[rest], run.k2[rest], run.t2[rest], 10 ** base[rest]))
    got = two >= 0
    if got.any():
        log[got] = trie.log_p(0, two[got])
    if len(trie.levels) > 1:
        short, at = log.copy(), np.flatnonzero(node >= 0)
        if len(at):
            log[at] += trie.log_b(0, node[at])
        if run is not None:
            rest = np.flatnonzero((three < 0) & (run.t3 > 0) & ((run.c3 > 0) | (node < 0)))
            log[rest] = np.log10(_smoothed(run.c3[rest], run.k3[rest], run.t3[rest], 10 ** short[rest]))
        got = three >= 0
        if got.any():
            log[got] = trie.log_p(1, three[got])
    return log


def scores(docs: DataFrame, order: int = ORDER, entries: int = ENTRIES, words: int = WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row
    of ``docs`` (doc_id, text, ...): log10 probabilities of the words alone, and by the model.

    Documents with crc32(doc_id as text) mod 5 = 1 are held out, the others train. A-Z is
    lower-cased; the end of a text is a token.

    Null and empty texts consist of the end token. A null doc_id trains and is scored. Repeated
    rows count as often as they stand there and are all scored. Without training documents
    train_tokens is 0 and every token has the same probability. Other columns are ignored, whatever their names.
    An empty table gives an empty result. A text of any length is one whole: it is held by one task at a time.
    """
    if not 2 <= order <= 3:
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with shuffles_freed(spark):
        vocabulary = written(word_counts(d), "words")
    table = frequent(vocabulary, entries, min(words, 1 << _SHIFT - 1))
    m = model(d, table, order, entries)
    name = put_file(spark, "trie", m.data)
    few = Table({}, table.counts, table.n_trie, table.tokens, table.distinct)
    shared = spark.sparkContext.broadcast((few, m.back, m.shared))

    @released
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (t, back, handed), trie = shared.value, _mapped(name)
        for batch in batches:
            for i in range(batch.num_rows):
                _, *row = (x[i].as_py() for x in batch.columns)
                r = _Run(row, handed)
                r.counted(row[4])
                if order > 2:
                    r.counted_three(row[5])
                base = t.log_base(r.count)[r.token]
                log = _ngram_logs(r.in_table, r.doc, base, t, trie, back, r)
                n = len(r.ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.ids, pa.int64()), pa.array(np.bincount(r.doc, minlength=n)),
                     pa.array(np.bincount(r.doc, r.count[r.token] > 0, n).astype(np.int64)),
                     pa.array(np.bincount(r.doc, base, n)), pa.array(np.bincount(r.doc, log, n))],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    kind = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    with batch_rows(spark, _ROWS), shuffles_freed(spark):
        out = written(m.runs.mapInArrow(score, kind), "scored")
    return out.select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        F.lit(table.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
