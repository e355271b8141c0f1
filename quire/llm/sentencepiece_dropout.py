"""SentencePiece (BPE) encoding with seeded merge-dropout, and lossless decoding.

Within a word, an agenda of candidate merges is worked off from the best score on.
A candidate is skipped when a keyed hash of (seed, document's id, word's number, word, place, merge) falls
under the dropout rate, so every occurrence of a word is cut on its own. The same seed always gives the same
pieces, whatever the partitioning and however often a task is retried.

What is kept in memory is a word's pieces without dropout and the merges that lead there: an
occurrence that skips none of these merges has these pieces, the others are worked off.

Pieces decode to the very text: white space runs, unknown characters and a literal
U+2581 (always written as byte pieces) survive. Dropout 0 gives the library's own pieces.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import byte_values, mix64, released, runs_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words kept in memory with their pieces and merges, for each Python worker.
CACHED_WORDS = 100_000
_ROWS = 1 << 15  # words that advance together
_MASK, _NONE, _ODD = (1 << 64) - 1, 1 << 62, 0x9E3779B97F4A7C15
_CHUNK = re.compile(r" *[^ ]+| +")


class _PairTable:
    """Merged piece of two neighbouring pieces, by open addressing in numpy arrays."""

    _FACTOR, _BITS = np.uint64(0x9E3779B97F4A7C15), 16

    def __init__(self, pairs: dict[int, int]):
        while 4 * len(pairs) > 1 << self._BITS:
            self._BITS += 1
        size = 1 << self._BITS
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, -1, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        for key, h, value in zip(keys.tolist(), self._place(keys).tolist(), pairs.values()):
            while self.keys[h] >= 0:
                h = (h + 1) % size
            self.keys[h], self.values[h] = key, value

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * self._FACTOR) >> np.uint64(64 - self._BITS)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The merged piece's id, or -1."""
        h = self._place(key)
        found = self.keys[h]
        out = np.where(found == key, self.values[h], -1)
        left = np.flatnonzero((found != key) & (found >= 0))
        while len(left):
            h[left] = (h[left] + 1) & (len(self.keys) - 1)
            found = self.keys[h[left]]
            hit = found == key[left]
            out[left[hit]] = self.values[h[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


class DropoutModel:
    """Vocabulary of a SentencePiece BPE model; segments, encodes and decodes."""

    def __init__(self, model_file: str, dropout: float, seed: int, variants: int | None = None):
        import sentencepiece

        if not 0 <= dropout < 1 or (variants is not None and variants < 1):
            raise ValueError("dropout must be in [0, 1) and variants at least 1")
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if size <= 1 << 16 else "I"
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}
        if len(self.byte_ids) < 256:
            raise ValueError(f"{model_file} has no byte pieces, so not every text can be decoded")
        words = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(SPACE in p.lstrip(SPACE) for p in (pieces[i] for i in words)):
            raise ValueError(f"{model_file} has pieces that reach over a space")
        self.ids = {pieces[i]: i for i in words}
        order = {s: k for k, s in enumerate(sorted({sp.get_score(i) for i in words}, reverse=True))}
        self.rank = {pieces[i]: order[sp.get_score(i)] << 44 for i in words}
        raw = [b""] * size
        for i in words:
            raw[i] = pieces[i].replace(SPACE, " ").encode()
        for b, i in self.byte_ids.items():
            raw[i] = bytes([b])
        self.raw = np.array(raw, object)
        self.is_byte = np.zeros(size, bool)
        self.is_byte[list(self.byte_ids.values())] = True
        self.line_break = array(self.code, [self.byte_ids[10]]).tobytes()
        self.literal = array(self.code, [self.byte_ids[b] for b in SPACE.encode()]).tobytes()
        self.below = int(dropout * (1 << 32))
        self.seed, self.variants = seed, variants
        self.caches: tuple[dict, dict] = ({}, {})  # of late, and before
        self.size, self.rank_of = size, np.zeros(size, np.int64)
        self.rank_of[words] = [self.rank[pieces[i]] >> 44 for i in words]
        self.id_of_char = np.full(0x110000, size, np.int32)  # ``size`` stands for characters without a piece
        for i in words:
            if len(pieces[i]) == 1:
                self.id_of_char[ord(pieces[i])] = i
        self.pairs = _PairTable({
            self.ids[p[:k]] * (size + 1) + self.ids[p[k:]]: i
            for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids
        })

    def places(self, key: int, n: int) -> np.ndarray:
        """What the cut of each of a document's ``n`` words hangs on."""
        if self.variants:
            return (np.arange(n, dtype=np.uint64) + np.uint64(key % self.variants)) % np.uint64(self.variants)
        return mix64(np.arange(1, n + 1, dtype=np.uint64) | np.uint64(key << 32 & _MASK))

    def segment(self, word: str, variant: int) -> list[int]:
        """Piece ids of a word with its leading space, or of one after a line break
        (with the break). Spaces before the word's last run of non-spaces belong to it."""
        if word[:1] == "\n":
            return [self.byte_ids[10], *self._agenda(word[1:], variant)]
        return self._agenda(SPACE + word.replace(" ", SPACE), variant)

    def _key(self, text: str, variant: int) -> int:
        return xxhash.xxh64_intdigest(text) ^ ((self.seed * 1009 + variant + 1) * _ODD & _MASK)

    def _agenda(self, text: str, variant: int) -> list[int]:
        return self._ids(self._long(text, self._key(text, variant), self.below))

    def _ids(self, part: list[str]) -> list[int]:
        ids = list(map(self.ids.get, part))
        if None in ids:
            ids = [x for p, i in zip(part, ids) for x in ([i] if i is not None else [self.byte_ids[b] for b in p.encode()])]
        return ids

    def _by_width(self, words: list[str]) -> Iterator[tuple[int, list[int]]]:
        """Numbers of words of about one length, and the length (0: long words)."""
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            n = len(w) + (w[:1] != "\n")
            by_size.setdefault(8 if n <= 8 else 16 if n <= 16 else 32 if n <= 32 else 0, []).append(i)
        for width, index in by_size.items():
            for lo in range(0, len(index), _ROWS):
                yield width, index[lo : lo + _ROWS]

    @staticmethod
    def _text(word: str) -> str:
        return word[1:] if word[:1] == "\n" else SPACE + word.replace(" ", SPACE)

    def segment_many(self, words: list[str], variant) -> list[bytes]:
        """``segment`` for many words, with one variant or one for each: short words advance
        together, a merge of each at a time."""
        variant = np.broadcast_to(np.asarray(variant, np.uint64), len(words))
        key = np.fromiter((xxhash.xxh64_intdigest(self._text(w)) for w in words), np.uint64, len(words)) ^ self._salt(variant)
        return self._occurrences(words, np.arange(len(words)), key)

    def _occurrences(self, words: list[str], which: np.ndarray, key: np.ndarray) -> list[bytes]:
        """Pieces of occurrences of words: the number of each one's word, and its key. What does not hang on the key is
        found once for a word."""
        out: list = [None] * len(which)
        size = np.zeros(len(words), np.int64)
        used = np.unique(which)
        size[used] = [len(words[k]) + (words[k][:1] != "\n") for k in used.tolist()]
        size = size[which]
        for least, width in ((0, 8), (9, 16), (17, 32)):
            index = np.flatnonzero((size >= least) & (size <= width))
            for lo in range(0, len(index), _ROWS):
                rows = index[lo : lo + _ROWS]
                own, of = np.unique(which[rows], return_inverse=True)
                own = [words[k] for k in own.tolist()]
                ids, counts, odd, _ = self._together([self._text(w) for w in own], key[rows], width, of)
                raw, ends = ids.astype(self.dtype).tobytes(), (np.cumsum(counts) * self.dtype.itemsize).tolist()
                head = [self.line_break if w[:1] == "\n" else b"" for w in own]
                for i, k, o, a, b in zip(rows.tolist(), of.tolist(), odd.tolist(), [0, *ends], ends):
                    if not o:
                        out[i] = head[k] + raw[a:b]
        for i in [i for i, x in enumerate(out) if x is None]:
            word = words[which[i]]
            head = self.line_break if word[:1] == "\n" else b""
            out[i] = head + array(self.code, self._ids(self._long(self._text(word), int(key[i]), self.below))).tobytes()
        return out

    def _salt(self, variant: np.ndarray) -> np.ndarray:
        return (variant + np.uint64((self.seed * 1009 + 1) & _MASK)) * np.uint64(_ODD)

    def _plain(self, words: list[str]) -> list[tuple[bytes, bytes, int]]:
        """Each word's pieces without dropout, the merges that lead there, and its hash."""
        out: list = [None] * len(words)
        for width, rows in self._by_width(words):
            texts, odd = [self._text(words[i]) for i in rows], np.ones(len(rows), bool)
            if width:
                ids, counts, odd, (of, merges) = self._together(texts, None, width)
                raw, ends = ids.astype(self.dtype).tobytes(), (np.cumsum(counts) * self.dtype.itemsize).tolist()
                steps = merges[np.argsort(of, kind="stable")].tobytes()
                stops = (np.cumsum(np.bincount(of, minlength=len(rows))) * 8).tolist()
                for i, t, a, b, c, d in zip(rows, texts, [0, *ends], ends, [0, *stops], stops):
                    head = self.line_break if words[i][:1] == "\n" else b""
                    out[i] = (head + raw[a:b], steps[c:d], xxhash.xxh64_intdigest(t))
            for k in np.flatnonzero(odd).tolist():
                taken: list[int] = []
                ids = array(self.code, self._ids(self._long(texts[k], 0, 0, taken))).tobytes()
                head = self.line_break if words[rows[k]][:1] == "\n" else b""
                out[rows[k]] = (head + ids, np.array(taken, np.int64).tobytes(), xxhash.xxh64_intdigest(texts[k]))
        return out

    def _together(self, texts: list[str], key: np.ndarray | None, width: int, of: np.ndarray | None = None) -> tuple:
        """Pieces of all texts (of one for each number in ``of``) in a row, their number for each text, and which texts have
        characters without a piece (their pieces are not valid). Without ``key`` none is skipped. Last,
        then, the merges and their texts."""
        n, none = len(texts), np.int64(_NONE >> 44)
        points = np.array(texts, f"<U{width}").view(np.uint32).reshape(n, width)
        size = np.fromiter(map(len, texts), np.int64, n)
        real = np.arange(width) < size[:, None]  # a text may hold U+0000, which pads as well
        part = np.where(real, self.id_of_char[points], self.size).astype(np.int64)
        odd = (real & (part == self.size)).any(axis=1)
        merged = np.full((n, width), -1, np.int32)
        merged[:, :-1] = self.pairs.find((part[:, :-1] * (self.size + 1) + part[:, 1:]).ravel()).reshape(n, width - 1)
        rank = np.where(merged >= 0, self.rank_of[merged], none).astype(np.int32)  # narrow: the least is looked for each time
        if of is not None:
            n, real, part, odd, merged, rank = len(of), real[of], part[of], odd[of], merged[of], rank[of]
        merges = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        alive, length = real.copy(), np.ones((n, width), np.int64)
        right, left = np.tile(np.arange(1, width + 1), (n, 1)), np.tile(np.arange(-1, width - 1), (n, 1))
        row = np.flatnonzero(~odd)

        def renew(r, at, after):
            """The candidate of piece ``at`` of rows ``r`` with the piece ``after`` it."""
            there = (after < width) & real[r, np.minimum(after, width - 1)]
            m = np.full(len(r), -1, np.int64)
            m[there] = self.pairs.find(part[r[there], at[there]] * (self.size + 1) + part[r[there], after[there]])
            merged[r, at] = m
            rank[r, at] = np.where(m >= 0, self.rank_of[m], none)

        while len(row):
            open_ = rank[row]
            at = open_.argmin(axis=1)
            best = open_[np.arange(len(row)), at].astype(np.int64)
            go = best < none
            row, at, best = row[go], at[go], best[go]
            nxt = right[row, at]
            total = length[row, at] + length[row, nxt]
            c = best << 44 ^ at << 12 ^ total
            if key is None:
                merges.append((row, c))
            if self.below and key is not None:
                skip = ((key[row] ^ c.astype(np.uint64)) * np.uint64(_ODD)) >> np.uint64(32) < np.uint64(self.below)
                rank[row[skip], at[skip]] = none
                r, i, j, total = row[~skip], at[~skip], nxt[~skip], total[~skip]
            else:
                r, i, j = row, at, nxt
            part[r, i], length[r, i], alive[r, j], rank[r, j] = merged[r, i], total, False, none
            after = right[r, j]
            right[r, i] = after
            inner = after < width
            left[r[inner], after[inner]] = i[inner]
            renew(r, i, after)
            before = left[r, i]
            some = before >= 0
            renew(r[some], before[some], i[some])
        return part[alive], alive.sum(axis=1), odd, tuple(map(np.concatenate, zip(*merges)))

    def _long(self, text: str, key: int, below: int, taken: list[int] | None = None) -> list[str]:
        """The agenda of a long word as a heap; candidates that a merge made void are passed over.
        The merges are added to ``taken``."""
        part, n = list(text), len(text)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        agenda = []
        for i in range(n - 1):
            r = rank.get(part[i] + part[i + 1])
            if r is not None:
                agenda.append(r | i << 12 | 2)
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            c = pop(agenda)
            i, size = (c >> 12) & 0xFFFFFFFF, c & 0xFFF
            a = part[i]
            if not a or (j := right[i]) >= n or len(a) + len(part[j]) != size:
                continue  # one of the two has been merged meanwhile
            if ((key ^ c) * _ODD & _MASK) >> 32 < below:
                continue
            if taken is not None:
                taken.append(c)
            a += part[j]
            part[i], part[j] = a, ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                r = rank.get(a + part[k])
                if r is not None:
                    push(agenda, r | i << 12 | size + len(part[k]))
            p = left[i]
            if p >= 0:
                r = rank.get(part[p] + a)
                if r is not None:
                    push(agenda, r | p << 12 | len(part[p]) + size)
        return [p for p in part if p]

    def encode_many(self, texts: list[str], keys: list[int]) -> list[bytes]:
        """Little-endian piece ids of each text. ``keys`` (of the documents) and the words' numbers
        make the segmentations differ."""
        odd = [SPACE in t or "  " in t or " \n" in t or t[:1] in (" ", "") or t[-1] == " " for t in texts]
        plain = pa.array([t for t, o in zip(texts, odd) if not o], pa.string())
        lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        coded = lists.flatten().dictionary_encode()
        words, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        sizes = np.diff(lists.offsets.to_numpy()).tolist()
        found = self._looked_up(set(words))
        known = [found[w] for w in words]
        ids = np.empty(len(known), object)
        ids[:] = [k[0] for k in known]
        ids = ids[which]
        if self.below and words:
            own = [k for k, o in zip(keys, odd) if not o]
            place = np.concatenate([self.places(k, n) for k, n in zip(own, sizes)])
            merges = [k[1] for k in known]
            key = np.fromiter((k[2] for k in known), np.uint64, len(known))[which] ^ self._salt(place)
            n = np.fromiter(map(len, merges), np.int64, len(merges)) // 8
            start, merges = (np.cumsum(n) - n)[which], np.frombuffer(b"".join(merges), np.uint64)
            n = n[which]
            ends = np.cumsum(n)
            at = np.repeat(start - (ends - n), n)
            at += np.arange(len(at))
            drawn = np.repeat(key, n)
            drawn ^= merges[at]
            drawn *= np.uint64(_ODD)
            skip = np.flatnonzero(drawn < np.uint64(self.below << 32))
            other = np.unique(np.searchsorted(ends, skip, "right"))
            if len(other):
                ids[other] = self._occurrences(words, which[other], key[other])
        out, lo, ids, sizes = [], 0, ids.tolist(), iter(sizes)
        for text, key, o in zip(texts, keys, odd):
            if o:
                out.append(self._odd(text, key))
                continue
            hi = lo + next(sizes)
            out.append(b"".join(ids[lo:hi]))
            lo = hi
        return out

    def _looked_up(self, needed: set) -> dict:
        """``_plain`` by word, for at least the words needed."""
        late, before = self.caches
        if len(late) > CACHED_WORDS:
            late, before = {}, late
            self.caches = (late, before)
        needed.difference_update(late)
        for w in needed.intersection(before):
            late[w] = before[w]
        new = list(needed.difference(before))
        late.update(zip(new, self._plain(new)))
        return late

    def forget(self) -> None:
        self.caches = ({}, {})

    def encode(self, text: str, key: int) -> bytes:
        return self.encode_many([text], [key])[0]

    def _odd(self, text: str, key: int) -> bytes:
        """Texts with runs of spaces, or with U+2581 itself."""
        if not text:
            return b""
        out, literal = [], False
        places = iter(self.places(key, len(text) + 1).tolist())
        for run in text.split(SPACE):
            out.append(self.literal if literal else b"")
            for k, line in enumerate(run.split("\n")):
                # after a line break or a literal U+2581 a word has no space of its own
                if k or literal:
                    head, space, line = line.partition(" ")
                    head = self._agenda(head, next(places)) if head else []
                    out.append(array(self.code, [self.byte_ids[10]] * bool(k) + head).tobytes())
                    if not space:
                        continue
                words = [c[1:] for c in _CHUNK.findall(" " + line)]
                for w in words:
                    out.append(array(self.code, self._agenda(SPACE + w.replace(" ", SPACE), next(places))).tobytes())
            literal = True
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The text of ``encode``'s ids, in UTF-8."""
        if not ids:
            return b""
        out = b"".join(self.raw[np.frombuffer(ids, self.dtype)].tolist())
        return out[1:]  # every text starts with the space that encoding put before it


@lru_cache(maxsize=4)
def load(model_file: str, dropout: float, seed: int, variants: int | None = None) -> DropoutModel:
    """One model for each Python worker and setting."""
    return DropoutModel(model_file, dropout, seed, variants)


def encode(
    docs: DataFrame, model_file: str = MODEL, dropout: float = 0.1, seed: int = 7, variants: int | None = None
) -> DataFrame:
    """doc_id, n_pieces, n_byte_pieces, ids (binary, little-endian, 2 bytes an id, 4 for
    vocabularies over 65,536) of every row of ``docs`` (doc_id, text, ...).

    Every occurrence of a word is cut on its own; ``variants`` bounds how many ways there are.
    Null and empty texts have no pieces (n_pieces 0, empty ids). A null doc_id is kept and
    counts as key 0. Repeated rows give equal results. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model_file, dropout, seed, variants)
        for batch in batches:
            sizes = [len(t) for t in byte_values(batch.column(1))]
            for lo, hi in runs_of(sizes, 2 << 20):
                part = batch.slice(lo, hi - lo)
                keys = [0 if k is None else xxhash.xxh32_intdigest(str(k)) for k in part.column(0).to_pylist()]
                ids = m.encode_many([t or "" for t in part.column(1).to_pylist()], keys)
                size = m.dtype.itemsize
                n_bytes = [int(m.is_byte[np.frombuffer(x, m.dtype)].sum()) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // size for x in ids], pa.int64()),
                     pa.array(n_bytes, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "n_pieces", "n_byte_pieces", "ids"],
                )
        m.forget()  # the worker may go on with other work

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_pieces long, n_byte_pieces long, ids binary"
    )


def decode(encoded: DataFrame, model_file: str = MODEL) -> DataFrame:
    """``encoded`` (with a column ids) with the decoded ``text`` added. Null ids give ''."""
    kept = [f for f in encoded.columns if f != "text"]
    schema = encoded.select(*kept).schema.add("text", "string")
    at = kept.index("ids")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = load(model_file, 0.0, 0, 1)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [m.decode(x or b"") for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*kept, "text"]
                )

    return encoded.select(*kept).mapInArrow(run, schema)
