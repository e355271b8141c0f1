import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quire.llm.chat_windows import chat_windows, escape, read_turns, unescape

MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[:]", "[/TURN]", "\\", "\\l", "<", "[", "é", "\n", " ok "]


@pytest.fixture(scope="module")
def turns(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        return df.withColumns({c: F.lit("other") for c in ("c", "row", "window", "lo", "tokens", "part")})

    return make


def made(seed=3, convs=30):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        t = 0
        if rng.random() < 0.5:
            rows.append((c, 0, "system", " ".join(["s"] * rng.randrange(0, 60))))
            t = 1
        for k in range(rng.randrange(1, 30)):
            role = ["user", "assistant", "tool", "system"][rng.choice([0, 1, 0, 1, 2, 3])]
            rows.append((c, t + k, role, "".join(rng.choices(MARKS, k=rng.randrange(0, 12))) + " w" * rng.randrange(0, 80)))
    return rows


def whole(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def read(df):
    out, loss = {}, {}
    for r in read_turns(df).orderBy("conv_id", "window").collect():
        out.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
        loss.setdefault(r.conv_id, []).extend(r.targets)
    return out, loss


def check(got, rows):
    turns_read, loss = got
    want = whole(rows)
    assert turns_read == want
    assert loss == {c: [x for role, x in t if role == "assistant"] for c, t in want.items()}


@pytest.mark.parametrize("budget,history,parts", [(128, 32, 2), (64, 0, 5), (100, 99, 3), (1, 0, 1)])
def test_round_trip(turns, budget, history, parts):
    rows = made()
    check(read(chat_windows(turns(rows), budget, history, parts)), rows)


def test_windows_keep_the_budget(turns):
    rows = made(5)
    opened = {c for c, t, role, _ in rows if t == 0 and role == "system"}
    got = chat_windows(turns(rows), 256, 64).collect()
    assert max(len([g for g in got if g.conv_id == c]) for c in range(30)) > 2
    for r in got:
        new = r.n_turns - r.n_context
        assert new >= 1 and (r.tokens <= 256 or new == 1)
        assert r.conv_id not in opened or r.text.startswith("<<SYS>>")
        for s in r.loss:
            assert r.text[s.start - 3 : s.start] == "<s>" and r.text[s.end : s.end + 4] == "</s>"


def test_hot_conversation_and_ties(turns):
    rows = [(1, k // 3, "user" if k % 2 else "assistant", f"t{k % 5}") for k in range(1500)] + [(2, None, None, None), (2, 0, "user", "x")]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    check(read(chat_windows(turns(rows), 64, 16, 7)), rows)


def test_long_text_and_empty_table(turns):
    rows = [(1, 0, "user", "y" * 100_000), (1, 1, "assistant", "<s> " * 5000), (1, 2, "assistant", "")]
    check(read(chat_windows(turns(rows))), rows)
    assert chat_windows(turns([])).collect() == []


def test_probe(turns):
    probe = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]
    df = chat_windows(turns(rows))
    check(read(df), rows)
    assert df.first().text.count("</s>") == 1


def test_native_plan(turns):
    df = read_turns(chat_windows(turns(made(1, 3))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.sampled_from("<>[]/\\sSYINTRU:lbe "), max_size=20) | st.lists(st.sampled_from(MARKS), max_size=6).map("".join), min_size=1, max_size=40))
def test_escape(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escape(F.col("t"))).withColumn("u", unescape(F.col("e")))
    for r in df.collect():
        assert r.u == r.t and not any(m in r.e for m in MARKS[:9])
