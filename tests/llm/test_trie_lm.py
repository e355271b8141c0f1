import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
from hypothesis import given, settings, strategies as st

from quire.llm.elias_fano import Sequence, Trie, Writer, arrays_of, write_trie
from quire.llm.trie_lm import scores

W = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**40) | st.integers(0, 50), max_size=200), st.lists(st.integers(0, 2**41), max_size=30))
def test_sequence(values, asked):
    v = np.sort(np.array(values, np.int64))
    w = Writer()
    w.sequence("s", v)
    s = Sequence(*arrays_of(w.bytes()), "s")
    assert s[np.arange(len(v))].astype(np.int64).tolist() == v.tolist()
    q = np.array(asked + values + [x + 1 for x in values], np.int64)
    assert s.successor(q).tolist() == np.searchsorted(v, q).tolist()


def test_trie_lookups():
    rng = np.random.default_rng(2)
    key = np.unique(rng.integers(0, 50 * 40, 700))
    t = Trie(write_trie([{"parent": key // 40, "word": key % 40, "log_p": -rng.random(len(key)), "log_b": np.zeros(len(key)), "above": 50}]))
    asked = np.arange(50 * 40)
    want = np.where(np.isin(asked, key), np.searchsorted(key, asked), -1)
    assert t.children(0, asked // 40, asked % 40).tolist() == want.tolist()


def tokens(t):
    return W.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + ["</end>"]


def base(rows):
    c = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    return c, n, lambda w: math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1)))


def made(seed=4, n=250):
    rng = random.Random(seed)
    follow = {k: rng.sample(range(30), 3) for k in range(30)}
    rows = []
    for i in range(n):
        k, out = rng.randrange(30), []
        for _ in range(rng.randrange(1, 60)):
            out.append(f"W{k}" if rng.random() < 0.95 else f"rare{rng.randrange(400)}")
            k = rng.choice(follow[k])
        rows.append((i, " ".join(out)))
    return rows


def test_base_and_odd_rows(docs_of, odd_rows):
    for rows, setting in ((odd_rows, {}), (made() + odd_rows, {"entries": 200, "words": 50})):
        c, n, p = base(rows)
        got = scores(docs_of(rows), **setting).collect()
        want = sorted((str(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), round(sum(map(p, tokens(t))), 5)) for i, t in rows)
        assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
        assert all(r.train_tokens == n and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in got)
    assert scores(docs_of([])).collect() == []


def test_contexts_sum_to_one(spark, docs_of):
    """Probabilities of all known words and an unknown one after a context add up to one, up
    to the quantisation."""
    from quire.llm.trie_lm import ORDER, _ngram_logs, build, frequent, word_counts

    df = docs_of(made()).select("doc_id", "text")
    t = frequent(word_counts(df), 1 << 20, 1 << 17)
    data, back = build(df, t, ORDER, 1 << 20)
    trie, ids = Trie(data), np.arange(len(t.ids))
    base_logs = t.log_base(t.counts)
    unknown = 10 ** t.log_base(np.array([0]))[0]
    for head in ([0], [3], [0, 1], [2, 5], [7, 0]):
        total = 0.0
        for w in [*ids, -1]:
            row = np.array([*head, w])
            p1 = np.where(row >= 0, base_logs[row], math.log10(unknown))
            total += 10 ** _ngram_logs(row, np.zeros(len(row), int), p1, t, trie, back)[-1]
        assert abs(total - 1) < 0.02


def test_held_out_text_is_better_than_by_words_alone(docs_of):
    got = [r for r in scores(docs_of(made(n=600)), order=3).collect() if r.held_out]
    two = [r for r in scores(docs_of(made(n=600)), order=2).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.8 * sum(r.base_score for r in got) and sum(r.score for r in two) > sum(r.base_score for r in two)


def textbook(rows):
    """Witten-Bell by the recursion, with all bigrams and trigrams of the training documents."""
    _, _, p1 = base(rows)
    c = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            w = tokens(t)
            for n in (2, 3):
                c.update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    total, kinds = Counter(), Counter()
    for g, k in c.items():
        total[g[:-1]] += k
        kinds[g[:-1]] += 1

    def p(g):
        if len(g) == 1:
            return 10 ** p1(g[0])
        low, head = p(g[1:]), g[:-1]
        return (c[g] + kinds[head] * low) / (total[head] + kinds[head]) if total[head] else low

    def score(t):
        w = tokens(t)
        return sum(math.log10(p(tuple(w[max(0, k - 2) : k + 1]))) for k in range(len(w)))

    return score


def test_scores_are_those_of_all_ngrams(docs_of, odd_rows):
    """Nothing, some and all of the n-grams in the trie: none is dropped."""
    rows = made() + odd_rows
    want = textbook(rows)
    for setting, most in (({"entries": 1, "words": 1}, 1e-9), ({"entries": 60, "words": 30}, 0.05), ({}, 0.05)):
        got = sorted((str(r.doc_id), round(r.n_tokens), r.score) for r in scores(docs_of(rows), **setting).collect())
        exact = sorted((str(i), len(tokens(t)), want(t)) for i, t in rows)
        assert [g[:2] for g in got] == [e[:2] for e in exact]
        assert all(abs(g[2] - e[2]) <= 1e-9 + most * abs(e[2]) for g, e in zip(got, exact)), setting


def test_a_rare_continuation_counts(docs_of):
    """A pair beyond the table raises the score: its words are as frequent as the others."""
    rows = [(i, f"a{k} b{k}") for k in range(40) for i in (10 * k, 10 * k + 2)]
    pair = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = [r.score for r in scores(docs_of(rows + [(pair, "a1 b1"), (pair, "a1 b2")]), entries=4, words=4).collect() if r.doc_id == pair]
    assert max(got) > min(got) + 0.5


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4) | st.integers(0, 2**31 - 1), st.integers(0, 4) | st.integers(0, 2**31 - 1)), max_size=60))
def test_distinct_pairs(pairs):
    from quire.llm.trie_lm import _distinct

    head, word, code = _distinct(*np.array(pairs, np.int64).reshape(-1, 2).T)
    found = list(zip(head.tolist(), word.tolist()))
    assert found == sorted(set(pairs)) and [found[k] for k in code] == pairs


def test_rare_ngrams_are_not_looked_up():
    """By the buckets' counts n-grams too rare for the trie are known: it is asked for each other one, once."""
    from quire.llm.trie_lm import Table, _ngram_logs, _Shared

    key = [(a, b) for a in range(10) for b in range(10) if (a + b) % 5 == 0]
    head, word = np.array(key).T
    above = {"log_p": -np.ones(len(key)), "log_b": np.zeros(len(key)), "above": 10}
    three = {"parent": np.arange(len(key)), "word": word, "log_p": -np.ones(len(key)), "log_b": np.zeros(len(key)), "above": len(key)}
    trie, asked = Trie(write_trie([{"parent": head, "word": word} | above, three])), [0, 0]
    find = trie.children

    def children(level, node, word):
        asked[level] += len(node)
        return find(level, node, word)

    trie.children = children
    ids = np.array([*range(10)] * 40 + [0, 5, 5] * 20)
    pairs = list(zip(ids[:-1].tolist(), ids[1:].tolist()))
    c2 = np.array([0, *(9 if p in key else 1 for p in pairs)])
    c3 = np.array([0, 0, *(9 if p in key and q in key and q[1] == p[1] else 1 for p, q in zip(pairs, pairs[1:]))])
    ones = np.ones(len(ids), np.int64)
    none = np.empty(0, np.int64)
    run = SimpleNamespace(c2=c2, c3=c3, k2=ones, t2=9 * ones, k3=ones, t3=9 * ones,
                          model=_Shared(8, 1000, 250, none, none, none, []))
    t = Table({}, np.full(10, 50), 10, 1000, 10)
    doc, base = np.zeros(len(ids), np.int64), np.full(len(ids), -1.0)
    got = _ngram_logs(ids, doc, base, t, trie, np.zeros(10, np.float32), run)
    assert asked == [len({p for p in pairs if p in key}), len({(p, q) for p, q in zip(pairs, pairs[1:]) if p in key and q in key and q[1] == p[1]})]
    assert got[402] == -1.0 and got[1] != -1.0  # in the trie; not in it


def test_runs_stay_where_they_are(spark, docs_of):
    """Only replies are shuffled for the joins with the runs, and the catalogue keeps nothing of them."""
    from quire.llm.trie_lm import frequent, model, word_counts

    df, before = docs_of(made()).select("doc_id", "text"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = model(df, frequent(word_counts(df), 60, 30), 3, 60)
        plan = m.runs._jdf.queryExecution().sparkPlan().toString()
        whole = m.runs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2 and whole.count("Exchange hashpartitioning(run") == 2, whole
    assert not [t.name for t in spark.catalog.listTables("default") if t.name.startswith("quire_runs")]
    assert sorted(i for r in m.runs.select("ids").collect() for i in r.ids) == [i for i, _ in made()]
