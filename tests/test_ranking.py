"""BM25 scores against a plain computation, and words that nobody has."""

import math
import re

import pytest

from quire import publish, ranked_search, write_index


@pytest.fixture()
def shop(ctx, spark):
    made = {}
    for name, text, tags, columns in (
        ("orders", "customer orders, by day", {"domain": ["sales"]}, "o_orderkey long, o_total double"),
        ("customer", "customers and their nation", {"domain": "sales", "tier": ["gold"]}, "c_custkey long, nation string"),
        ("events", "click stream events events", None, "ts timestamp, user string"),
        ("nation", "", {}, "n_name string"),
    ):
        made[name] = publish(ctx, spark.createDataFrame([], columns), name, text or "-", tags=tags)["dataset_id"]
    return made


DOCS = {
    "orders": "orders customer orders, by day domain sales o_orderkey o_total",
    "customer": "customer customers and their nation domain sales tier gold c_custkey nation",
    "events": "events click stream events events ts user", "nation": "nation - n_name",
}


def _terms(text):
    return re.findall(r"[^\W_]+", text.lower())


def _plain(words):
    docs = {n: _terms(t) for n, t in DOCS.items()}
    mean = sum(map(len, docs.values())) / len(docs)
    out = {}
    for w, weight in words.items():
        df = sum(w in d for d in docs.values())
        for n, d in docs.items():
            if tf := d.count(w):
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                out[n] = out.get(n, 0) + weight * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    return out


def _got(df):
    return {r["name"]: r["score"] for r in df.collect()}


@pytest.mark.parametrize("text", ["orders", "customer nation", "events stream sales SALES", "orderkey", "gold tier nation"])
def test_scores(ctx, shop, text):
    assert _got(ranked_search(ctx, text)) == pytest.approx(_plain(dict.fromkeys(_terms(text), 1.0)))


def test_misspelt_words_stand_for_the_likest(ctx, shop):
    got = _got(ranked_search(ctx, "evnts"))
    grams = lambda w: {f"  {w} "[i : i + 3] for i in range(len(w) + 1)}
    like = len(grams("evnts") & grams("events")) / len(grams("evnts") | grams("events"))
    assert got == pytest.approx(_plain({"events": like})) and list(got) == ["events"]
    assert _got(ranked_search(ctx, "qqqqq")) == {}


def test_stored_index(ctx, shop):
    path = write_index(ctx)
    assert _got(ranked_search(ctx, "customer nation", path)) == pytest.approx(_plain({"customer": 1.0, "nation": 1.0}))
    with pytest.raises(TypeError):
        ranked_search(ctx, " ")
    with pytest.raises(ValueError):
        ranked_search(ctx, "--")
