import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quire.llm import conversation_repair as cr
from quire.llm.queries_repair import damaged, digests

BLANK = " \t\n\x0b\x0c\r"
PATTERN = re.compile(r"(s?(ua)+)?")


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        t = text.rstrip(BLANK)
        out.append("blank" if not t.strip(BLANK) else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Least (cost, audit) with its turns, by trying prefixes of role strings row by row."""
    def fits(s):  # some word of the pattern begins so
        return re.fullmatch(r"s?(ua)*u?", s) is not None

    best = {"": (0, "", ())}  # by role string so far, only as much of it as matters

    def state(s):
        return s if s in ("", "s") else "u" if s.endswith("u") else "a"

    def grow(layer):
        while True:
            more = dict(layer)
            for cost, audit, turns in list(layer.values()):
                roles = "".join(t[0][0] for t in turns)
                for new in ("user", "assistant"):
                    if fits(roles + new[0]):
                        put(more, (cost + 2, audit + "I", (*turns, (new, ""))))
            if more == layer:
                return layer
            layer = more

    def put(layer, item):
        key = state("".join(t[0][0] for t in item[2]))
        if key not in layer or item[:2] < layer[key][:2]:
            layer[key] = item

    for (_, role, text), kind in zip(rows, kinds):
        layer = {}
        for cost, audit, turns in grow(best).values():
            roles = "".join(t[0][0] for t in turns)
            put(layer, (cost + 3, audit + "D", turns))
            if kind not in ("blank", "duplicate"):
                for new, edit, price in ((role, "K", 0), ("user", "R", 2), ("assistant", "R", 2)):
                    if new[:1] in ("s", "u", "a") and fits(roles + new[0]):
                        put(layer, (cost + price + (kind == "truncated"), audit + edit, (*turns, (new, text))))
        best = layer
    done = [x for x in grow(best).values() if PATTERN.fullmatch("".join(t[0][0] for t in x[2]))]
    return min(done, key=lambda x: x[:2])


def brute(rows):
    """Answer for each conversation of (conv, turn, role, text) rows."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted([(r[1], r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " ") for r in rows if r[0] == conv],
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        kinds = faults(mine)
        cost, audit, turns = cheapest(mine, kinds)
        numbers = {r[0] for r in mine if r[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        text = "\n".join(f"{a}:{b}" for a, b in turns)
        out[conv] = (gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(3)
    return df.withColumns({c: F.lit("x") for c in ("n", "k", "h", "chunk", "first", "again", "cost", "edits", "state", "symbols")})


def _got(df):
    counts, turns = cr.repaired(df)
    sha = {r[0]: r[1] for r in digests(turns).collect()}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return {r["conv_id"]: (*[r[n] for n in names], sha[r["conv_id"]]) for r in counts.collect()}


def test_all_short_symbol_strings():
    """Every string of up to four symbols against the search over role strings, in any cut into parts."""
    names = ["system", "user", "assistant", "tool"]
    for n in range(5):
        for symbols in itertools.product(range(9), repeat=n):
            if n == 4 and random.Random(str(symbols)).random() > 0.15:
                continue
            rows = [(i, names[s % 4], f"t{i}") if s < 8 else (i, "user", "") for i, s in enumerate(symbols)]
            kinds = ["blank" if s == 8 else "truncated" if s > 3 else "" for s in symbols]
            want = cheapest(rows, kinds)
            cost, parts = cr.trace([bytes(symbols[: n // 2]), bytes(symbols[n // 2 :])])
            assert (cost, "".join(p[1] for p in parts)) == want[:2]
            got = []
            for (state, edits), mine in zip(parts, (rows[: n // 2], rows[n // 2 :])):
                got += cr.apply_edits(state, edits, [r[1].encode() for r in mine], [r[2].encode() for r in mine], [1] * len(mine))
            assert tuple((a.decode(), b.decode()) for a, b in got) == want[2]


@pytest.mark.parametrize("block", [1, 2, 3, 5])
def test_any_block_length_gives_the_same_trace(block):
    rng = random.Random(block)
    for n in (0, 1, 7, 40, 333):
        s = bytes(rng.choices(range(9), k=n))
        assert cr.trace([s], block) == cr.trace([s])


def test_random_conversations_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(cr, "_CHUNK_ROWS", 3)
    rng = random.Random(7)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(0, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "User"])
            text = rng.choice(["ok.", "no", " ", "", "why? \n", "x" * 300, "é!", "x" * 300 + "."])
            rows += [(conv, rng.choice([turn, turn, turn + 2, None]), role, text)] * rng.choice([1, 1, 1, 2, 4])
    rows += [(None, 1, "user", "a."), (None, None, None, None), (None, 2, "assistant", None)]
    assert _got(_frame(spark, rows)) == brute(rows)


def test_one_conversation_with_most_rows(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i // 3}" + "." * (i % 5 > 0)) for i in range(5000)] + [(2, 0, "user", "a.")] * 900
    got = _got(_frame(spark, rows))
    assert set(got) == {1, 2} and len(got[1][6].replace("I", "")) == 5000
    assert got[2] == brute(rows[5000:])[2]
    small = [r for r in rows if r[0] == 2 or r[1] < 60]
    assert _got(_frame(spark, small)) == brute(small)


def test_empty_table(spark):
    counts, turns = cr.repaired(_frame(spark, []))
    assert counts.count() == 0 and digests(turns).count() == 0


def test_query_on_damaged_rows(spark, tmp_path):
    from quire.llm.queries_repair import op11_conversation_repair

    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["Yes. No!", None, "hm", "a?"])) for c in range(150) for t in range(rng.randrange(1, 7))]
    rows += [(None, None, "user", "a."), (7, None, "user", "b.")]
    _frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    bad = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        bad += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, damaged(_frame(spark, rows)).collect()), key=key) == sorted(bad, key=key)
    want = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in {r[0] for r in rows}} | brute(bad)
    got = {r[0]: tuple(r)[1:] for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == want
