"""Cheapest repair of conversations by block tables (the Four-Russians method).

A conversation's turns are symbols: the initial of the role, whether the text is cut off, or that the turn must
go. The cost of repairing what follows, seen from each state of the role pattern ``(s?(ua)+)?``, is a vector
of four numbers; less its minimum it is one of a few dozen vectors, as an insertion takes every state to any
other at bounded cost. So what a block of symbols does to a vector is a table over vectors and blocks, made
once. Conversations are processed from their end by one lookup a block. Then blocks are
expanded again against that direction, from the first turn on: of the edits that keep to the
cheapest cost, the ASCII-least is taken, which so gives the least of all cheapest audits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quire.llm.common import batch_rows, byte_values, written

DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1  # costs; keeping is free
BLOCK = 4
GONE = 8  # the symbol of a turn that must be deleted; others are 4 * cut off + role
SYMBOLS = 9
_NEXT = [{0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2}]  # states of the pattern: by role s, u, a
_MADE = [(1, 2), (1, 2), (2, 3), (1, 2)]  # the role that an insertion or a new role has in a state, and where it leads
_ENDS = (0, 3)
_ROLES = {0: b"system", 1: b"user", 2: b"assistant"}
_BIG = 1 << 20
_CHUNK_ROWS, _CHUNK_BYTES = 1000, 1 << 20
_BLANKS = b" \t\n\x0b\x0c\r"


def _closed(v: list[int]) -> list[int]:
    """Costs with insertions before the next turn."""
    for _ in range(3):
        v = [min(c, INSERT + v[_MADE[q][1]]) for q, c in enumerate(v)]
    return v


def _choices(symbol: int, after: list[int], q: int) -> list[tuple[str, int, int, int | None]]:
    """(edit, cost to the end, next state, role) for a turn in state q."""
    out = [("D", DELETE + after[q], q, None)]
    if symbol != GONE:
        role, cut = symbol % 4, CUT * (symbol // 4)
        if role in _NEXT[q]:
            out.append(("K", cut + after[_NEXT[q][role]], _NEXT[q][role], role))
        out.append(("R", REROLE + cut + after[_MADE[q][1]], _MADE[q][1], _MADE[q][0]))
    return out


class Tables:
    """All normalised vectors, the block table and the edits in each situation."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = _closed([0 if q in _ENDS else _BIG for q in range(4)])
        self.end = 0
        vectors, number, self.steps = [tuple(end)], {tuple(end): 0}, []
        one, cost = [], []
        for v in vectors:  # grows while new vectors turn up
            one.append([]), cost.append([])
            for s in range(SYMBOLS):
                w = _closed([min(c for _, c, _, _ in _choices(s, list(v), q)) for q in range(4)])
                low = min(w)
                key = tuple(c - low for c in w)
                if key not in number:
                    number[key] = len(vectors)
                    vectors.append(key)
                one[-1].append(number[key])
                cost[-1].append(low)
        self.vectors, self.one = vectors, one
        # a block's number has its first symbol in front; the last symbol is processed first
        first, added = np.array(one, np.int16), np.array(cost, np.int32)
        to, sums = first, added
        for _ in range(block - 1):
            to, sums = (
                np.concatenate([first[to, s] for s in range(SYMBOLS)], axis=1),
                np.concatenate([sums + added[to, s] for s in range(SYMBOLS)], axis=1),
            )
        self.to, self.sums, self.cost = to, sums, cost
        # by vector after the turn, symbol and state: the edits up to and with the turn, and the next state
        self.edits = [[[self._edit(list(v), s, q) for q in range(4)] for s in range(SYMBOLS)] for v in vectors]
        self.tails = [self._tail(q) for q in range(4)]

    def _edit(self, after: list[int], symbol: int, q: int) -> tuple[str, int]:
        best = _closed([min(c for _, c, _, _ in _choices(symbol, after, p)) for p in range(4)])
        said = ""
        while True:
            ways = {e: (c, to) for e, c, to, _ in _choices(symbol, after, q)} | {"I": (INSERT + best[_MADE[q][1]], _MADE[q][1])}
            edit = min(e for e, (c, _) in ways.items() if c == best[q])
            said, q = said + edit, ways[edit][1]
            if edit != "I":
                return said, q

    def _tail(self, q: int) -> str:
        """Insertions after the last turn."""
        return "" if q in _ENDS else "I" + self._tail(_MADE[q][1])


@lru_cache(maxsize=4)
def tables(block: int = BLOCK) -> Tables:
    return Tables(block)


def trace(symbols: list[bytes], block: int = BLOCK) -> tuple[int, list[tuple[int, str]]]:
    """Cost of the cheapest repair of a conversation, and for each of its parts the state in which it
    begins and its edits."""
    t = tables(block)
    flat = b"".join(symbols)
    n = len(flat)
    head = n % block  # turns before the first whole block
    codes = np.frombuffer(flat, np.uint8)[head:].reshape(-1, block).astype(np.int64) @ SYMBOLS ** np.arange(block - 1, -1, -1)
    after, now, cost = [0] * len(codes), t.end, 0
    to, sums = t.to, t.sums
    for k in range(len(codes) - 1, -1, -1):
        after[k] = now
        cost += int(sums[now, codes[k]])
        now = int(to[now, codes[k]])
    seen = [0] * head
    for i in range(head - 1, -1, -1):
        seen[i] = now
        cost, now = cost + t.cost[now][flat[i]], t.one[now][flat[i]]
    cost += t.vectors[now][0]
    out, q, at, inner = [], 0, 0, seen
    base = 0  # where ``inner`` begins
    for part in symbols:
        start, said = q, []
        for s in part:
            if at - base == len(inner):  # the next block: its vectors from its end backward
                base = at
                v, inner = after[(at - head) // block], [0] * block
                for j in range(block - 1, -1, -1):
                    inner[j], v = v, t.one[v][flat[at + j]]
            edit, q = t.edits[inner[at - base]][s][q]
            said.append(edit)
            at += 1
        out.append((start, "".join(said)))
    if out:
        out[-1] = (out[-1][0], out[-1][1] + t.tails[q])
    return cost, out


def apply_edits(state: int, edits: str, roles: list[bytes], texts: list[bytes], copies: list[int]) -> list[tuple[bytes, bytes]]:
    """The repaired turns of a part; ``copies``: how often each turn stands there."""
    out, rows, q = [], iter([(r, x) for r, x, n in zip(roles, texts, copies) for _ in range(n)]), state
    for e in edits:
        if e == "D":
            next(rows)
        elif e == "I":
            out.append((_ROLES[_MADE[q][0]], b""))
            q = _MADE[q][1]
        else:
            role, text = next(rows)
            if e == "R":
                out.append((_ROLES[_MADE[q][0]], text))
                q = _MADE[q][1]
            else:
                out.append((role, text))
                q = _NEXT[q]["sua".index(chr(role[0]))]
    return out


_CHUNKS = (
    "conv_id long, symbols binary, roles array<binary>, texts array<binary>, copies array<long>, blank long, duplicate long, "
    "truncated long, illegal long, n_turns long, low long, high long, first_turn long, last_turn long, head string, tail string"
)
_LEGAL = {"su", "ua", "au"}


def _chunks(rows: DataFrame) -> DataFrame:
    """Sorted turns as chunks: neighbouring turns of one conversation, with their symbols and counts."""
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.list_(pa.int64()), *[pa.int64()] * 9, pa.string(), pa.string()]
    names = [c.split()[0] for c in _CHUNKS.split(", ")]

    def close(conv, turns: list[tuple]) -> tuple:
        symbols, blank, dup, cut, illegal, last = [], 0, 0, 0, 0, None
        numbers: list[int] = []
        for turn, role, text, n, repeated in turns:
            stripped = text.rstrip(_BLANKS)
            initial = role[:1].decode("latin-1")
            kind = {"s": 0, "u": 1, "a": 2}.get(initial, 3)
            shown = initial if kind < 3 else "?"
            illegal += (n - 1) + (last is not None and last + shown not in _LEGAL)
            last = shown
            if turn is not None and (not numbers or numbers[-1] != turn):
                numbers.append(turn)
            if not stripped:
                blank += n
                symbols.append(bytes([GONE]) * n)
            elif repeated:
                dup += n
                symbols.append(bytes([GONE]) * n)
            else:
                late = stripped[-1:] not in (b".", b"!", b"?")
                cut, dup = cut + late, dup + n - 1
                symbols.append(bytes([kind + 4 * late]) + bytes([GONE]) * (n - 1))
        first = turns[0][1][:1].decode("latin-1")
        ends = (numbers[0], numbers[-1], numbers[0], numbers[-1]) if numbers else (None,) * 4
        return (conv, b"".join(symbols), [t[1] for t in turns], [t[2] for t in turns], [t[3] for t in turns], blank, dup, cut, illegal,
                len(numbers), *ends, first if first in ("s", "u", "a") else "?", last)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, size, out = None, [], 0, []
        held = 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for batch in batches:
            ids, numbers, copies, repeated = (batch.column(k).to_pylist() for k in (0, 1, 4, 5))
            for c, turn, role, text, n, again in zip(ids, numbers, byte_values(batch.column(2)), byte_values(batch.column(3)), copies, repeated):
                if turns and (c != conv or len(turns) >= _CHUNK_ROWS or size >= _CHUNK_BYTES):
                    out.append(close(conv, turns))
                    held, turns, size = held + size, [], 0
                    if held > _CHUNK_BYTES or len(out) >= 2000:
                        yield batch_of()
                        out, held = [], 0
                conv = c
                turns.append((turn, role, text, n, again))
                size += len(text) + 50
        if turns:
            out.append(close(conv, turns))
        if out:
            yield batch_of()

    return rows.mapInArrow(pack, _CHUNKS)


def _edited(chunks: DataFrame, block: int) -> DataFrame:
    """(chunk, state, edits, cost, illegal, n_turns): of each chunk its edits; what neighbouring
    chunks of a conversation share is counted once. A conversation's symbols are held by one task, a byte a turn."""
    schema = "chunk long, state int, edits string, cost long, more_illegal long, less_turns long"
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def of_conv(rows: list[tuple]) -> Iterator[tuple]:
        cost, parts = trace([r[2] for r in rows], block)
        before = None
        for k, (r, (state, edits)) in enumerate(zip(rows, parts)):
            cross = same = 0
            if before is not None:
                cross = int(before[6] + r[5] not in _LEGAL)
                same = int(r[3] is not None and r[3] == before[4])
            yield r[1], state, edits, cost if k == 0 else 0, cross, same
            before = r

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            out = []
            for r in zip(*[batch.column(k).to_pylist() for k in range(7)]):
                if held and held[-1][0] != r[0]:
                    out += of_conv(held)
                    held = []
                held.append(r)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], [x.split()[0] for x in schema.split(", ")])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*of_conv(held)), kinds)], [x.split()[0] for x in schema.split(", ")])

    rows = chunks.select("conv_id", "chunk", "symbols", "first_turn", "last_turn", "head", "tail")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(fold, schema)


def repaired(conversations: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Audit and repair of ``conversations`` (conv_id, turn, role, text, ...).

    A conversation's rows stand by turn (nulls first), then role and text. Returns

    * conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: one row a conversation. Each row's first
      fault counts: blank text, role and text seen earlier, text that does not end in ``.``, ``!`` or ``?``. ``gaps``:
      turn numbers missing between the smallest and the largest. ``illegal``: neighbours
      whose role initials are not su, ua or au. ``audit``: the cheapest edits' initials
      (Keep, Rerole, Delete, Insert), ties to the ASCII-least.
    * conv_id, chunk, turns: the repaired turns (role, text); chunks of a conversation in order of ``chunk``.

    A null role or text counts as one space; a role with another initial than s, u or a (as they are, in lower case)
    cannot be kept. Null turns stand first and count for no gap. Rows without conv_id are one conversation. Repeated
    rows are duplicates of the first. Other columns are ignored, whatever their names. An empty table gives two
    empty results. A conversation of any length is cut in chunks; only its symbols and
    its audit, a byte a turn, are held whole.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role"), space("text"))
    rows = rows.withColumns({"h": F.xxhash64("conv_id", "role", "text"), "g": F.xxhash64("text", F.lit(1), "role", "conv_id")})
    # rows that are alike in all are one row with a count, so no number of them makes a hot key
    rows = rows.groupBy("conv_id", "turn", "h", "g").agg(F.first("role").alias("role"), F.first("text").alias("text"), F.count("*").alias("n"))
    rows = written(rows, "turns")
    seen = rows.groupBy("h", "g").agg(F.min(F.struct(F.col("turn").isNotNull().alias("k"), "turn")).alias("first"), F.count("*").alias("m"))
    rows = rows.join(seen.filter("m > 1").drop("m"), ["h", "g"], "left")
    again = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    rows = rows.select("conv_id", "turn", "role", "text", "n", again.alias("again"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal starts of a text stay together, as the rest of the text then gives the order
    rows = rows.repartitionByRange(parts, "conv_id", "turn", F.substring("role", 1, 20), F.substring("text", 1, 100))
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text")
    with batch_rows(rows.sparkSession, 1000):
        chunks = written(_chunks(rows).withColumn("chunk", F.monotonically_increasing_id()), "chunks")
        edits = written(_edited(chunks, block), "edits")
    both = chunks.join(edits, "chunk")
    counts = both.groupBy("conv_id").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - (F.sum("n_turns") - F.sum("less_turns")), F.lit(0)).alias("gaps"),
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        (F.sum("illegal") + F.sum("more_illegal")).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "edits"))), lambda x: x["edits"]), "").alias("audit"),
    )

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = pa.list_(pa.struct([("role", pa.binary()), ("text", pa.binary())]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                p = batch.slice(lo, 100)
                states, edits, roles, texts, copies = (p.column(k).to_pylist() for k in range(2, 7))
                out = [[{"role": r, "text": x} for r, x in apply_edits(*a)] for a in zip(states, edits, roles, texts, copies)]
                yield pa.RecordBatch.from_arrays([p.column(0), p.column(1), pa.array(out, turn)], ["conv_id", "chunk", "turns"])

    turns = both.select("conv_id", "chunk", "state", "edits", "roles", "texts", "copies").mapInArrow(
        mend, "conv_id long, chunk long, turns array<struct<role:binary,text:binary>>")
    as_text = F.transform("turns", lambda t: F.struct(t["role"].cast("string").alias("role"), t["text"].cast("string").alias("text")))
    return counts, turns.select("conv_id", "chunk", as_text.alias("turns"))
