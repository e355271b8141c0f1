"""Elias-Fano sequences in numpy, and an n-gram trie made of them.

A sequence keeps the low bits of its values packed and the high bits in unary, with the
number of ones before each 64-bit word as directory. All calls work on arrays of queries.
Everything lies in one buffer, so a file of it can be memory-mapped.
"""

from __future__ import annotations

import json

import numpy as np

_U = np.uint64


class Writer:
    """Collects named arrays into one buffer behind a JSON table of contents."""

    def __init__(self):
        self.arrays: dict[str, np.ndarray] = {}
        self.meta: dict = {}

    def sequence(self, name: str, values: np.ndarray) -> None:
        """A non-decreasing sequence of integers below 2**62."""
        v = np.asarray(values, np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        low = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (v >> _U(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros((n + (top >> low) + 1 + 63) // 64 + 1, np.uint64)
        np.bitwise_or.at(bits, high >> 6, _U(1) << (high & 63).astype(np.uint64))
        packed = np.zeros((n * low + 63) // 64 + 2, np.uint64)
        if low and n:
            rest, at = v & _U((1 << low) - 1), np.arange(n, dtype=np.uint64) * _U(low)
            word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
            np.bitwise_or.at(packed, word, rest << off)
            over = off + _U(low) > _U(64)
            np.bitwise_or.at(packed, word[over] + 1, rest[over] >> (_U(64) - off[over]))
        self.arrays |= {
            f"{name}.high": bits, f"{name}.low": packed,
            f"{name}.ones": np.concatenate(([0], np.cumsum(np.bitwise_count(bits)))).astype(np.uint32),
        }
        self.meta[name] = {"n": n, "low": low}

    def bytes(self) -> bytes:
        at, table = 0, {}
        for k, a in self.arrays.items():
            table[k] = [str(a.dtype), len(a), at]
            at += -(-a.nbytes // 8) * 8
        head = json.dumps({"arrays": table, "meta": self.meta}).encode()
        head += b" " * (-(len(head) + 8) % 8)
        body = b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in self.arrays.values())
        return len(head).to_bytes(8, "little") + head + body


class Sequence:
    """Read access to one sequence of a buffer."""

    def __init__(self, arrays: dict, meta: dict, name: str):
        self.n, self.low = meta[name]["n"], meta[name]["low"]
        self.bits, self.packed, self.ones = (arrays[f"{name}.{k}"] for k in ("high", "low", "ones"))
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    @staticmethod
    def _select_in(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Place of the ``rank``-th one (from 0) in each word, by halving."""
        at, rank = np.zeros(len(word), np.int64), rank.astype(np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            part = (word >> at.astype(np.uint64)) & _U((1 << width) - 1)
            ones = np.bitwise_count(part).astype(np.int64)
            right = rank >= ones
            rank -= np.where(right, ones, 0)
            at += np.where(right, width, 0)
        return at

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _U(self.low)
        word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
        v = self.packed[word] >> off
        over = off + _U(self.low) > _U(64)
        v[over] |= self.packed[word[over] + 1] << (_U(64) - off[over])
        return v & _U((1 << self.low) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, "right") - 1
        at = word * 64 + self._select_in(self.bits[word], i - self.ones[word])
        return ((at - i).astype(np.uint64) << _U(self.low)) | self._lows(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part below ``high``."""
        rank = np.maximum(high - 1, 0)
        word = np.minimum(np.searchsorted(self.zeros, rank, "right") - 1, len(self.bits) - 1)
        at = word * 64 + self._select_in(~self.bits[word], rank - self.zeros[word])
        return np.where(high <= 0, 0, np.minimum(at - rank, self.n))

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value that is at least ``x`` (n if there is none)."""
        x = np.asarray(x, np.uint64)
        high = np.minimum(x >> _U(self.low), _U(1 << 60)).astype(np.int64)
        most = len(self.bits) * 64 - self.n - 1
        beyond = high > most
        high = np.minimum(high, most)
        lo, hi = self._before(high), self._before(high + 1)
        rest = x & _U((1 << self.low) - 1)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            less = open_.copy()
            less[open_] = self._lows(mid[open_]) < rest[open_]
            lo = np.where(less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        return np.where(beyond, self.n, lo)


def arrays_of(buffer) -> tuple[dict, dict]:
    """The named arrays of a ``Writer``'s buffer (a memory map or bytes), without copying."""
    raw = np.frombuffer(buffer, np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8 : 8 + size].tobytes())
    body = raw[8 + size :]
    arrays = {k: body[at : at + n * np.dtype(t).itemsize].view(t) for k, (t, n, at) in head["arrays"].items()}
    return arrays, head["meta"]


def quantised(values: np.ndarray, bits: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ``values`` and their code book: means of bins with equal numbers of values."""
    if not len(values):
        return np.empty(0, np.uint8), np.zeros(1 << bits)
    order = np.argsort(values, kind="stable")
    code = np.empty(len(values), np.uint8)
    code[order] = np.arange(len(values)) * (1 << bits) // len(values)
    n = np.bincount(code, minlength=1 << bits)
    return code, np.bincount(code, values, 1 << bits) / np.maximum(n, 1)


def write_trie(levels: list[dict]) -> bytes:
    """``levels[k]`` (k = 0 for bigrams) has parent (index of the node above, sorted), word
    (ascending within a parent), log_p and log_b (back-off of the node, 0 if none), and ``above``,
    the number of nodes above."""
    w = Writer()
    for k, g in enumerate(levels):
        parent, word = np.asarray(g["parent"], np.int64), np.asarray(g["word"], np.int64)
        w.sequence(f"{k}.pointers", np.searchsorted(parent, np.arange(g["above"] + 1)))
        # ids relative to the context: each range continues where the one before ended
        last = np.flatnonzero(np.diff(parent, append=-1)) if len(parent) else np.empty(0, np.int64)
        base = np.concatenate(([0], np.cumsum(word[last] + 1)[:-1])) if len(last) else np.empty(0, np.int64)
        sizes = np.diff(np.concatenate(([-1], last)))
        w.sequence(f"{k}.words", word + np.repeat(base, sizes))
        for field in ("log_p", "log_b"):
            code, book = quantised(np.asarray(g[field], np.float64))
            w.arrays |= {f"{k}.{field}": code, f"{k}.{field}.book": book}
    w.meta["levels"] = len(levels)
    return w.bytes()


class Trie:
    """Looks up children of nodes; nodes above the first level are word ids."""

    def __init__(self, buffer):
        arrays, meta = arrays_of(buffer)
        self.levels = [
            (Sequence(arrays, meta, f"{k}.pointers"), Sequence(arrays, meta, f"{k}.words"),
             *((arrays[f"{k}.{f}"], arrays[f"{k}.{f}.book"]) for f in ("log_p", "log_b")))
            for k in range(meta["levels"])
        ]

    def children(self, level: int, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Index in ``level`` of each node's child ``word``, or -1: the successor of the
        word, counted from where the node's range begins."""
        pointers, words, _, _ = self.levels[level]
        out = np.full(len(node), -1)
        if not words.n:
            return out
        lo, hi = pointers[node].astype(np.int64), pointers[node + 1].astype(np.int64)
        some = np.flatnonzero(lo < hi)
        lo, hi = lo[some], hi[some]
        base = np.where(lo > 0, words[np.maximum(lo - 1, 0)] + _U(1), _U(0))
        x = base + word[some].astype(np.uint64)
        at = words.successor(x)
        hit = at < hi
        hit[hit] = words[at[hit]] == x[hit]
        out[some[hit]] = at[hit]
        return out

    def log_p(self, level: int, node: np.ndarray) -> np.ndarray:
        code, book = self.levels[level][2]
        return book[code[node]]

    def log_b(self, level: int, node: np.ndarray) -> np.ndarray:
        code, book = self.levels[level][3]
        return book[code[node]]
