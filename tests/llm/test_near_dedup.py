import random
import re
from itertools import combinations

import numpy as np
import pytest
from conftest_llm import components

from quire.llm.components import connected_components
from quire.llm.near_dedup import bands_for, circulant_signatures, near_duplicates, shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(rows):
    out = {}
    for i, t in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = WORD.findall(low)
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        out.setdefault(i, []).append(s)
    return out


def brute(rows, percent):
    sets = brute_sets(rows)
    edges = []
    for a, b in combinations([i for i in sets if i is not None], 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            edges.append((a, b))
    return components(sets, edges)


def edited(words, n, rng):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def copies(seed=1, groups=4, size=25):
    rng, rows, i = random.Random(seed), [], 100
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 220))]
        for _ in range(size):
            rows.append((i, edited(base, rng.randrange(0, 6), rng)))
            i += rng.randrange(1, 4)
    return rows


@pytest.mark.parametrize("percent", [85, 80])
def test_components_match_brute_force(docs_of, percent):
    rows = copies()
    want = brute(rows, percent)
    got = {r.doc_id: r for r in near_duplicates(docs_of(rows), percent=percent).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s[0]) for i, s in brute_sets(rows).items()}


def test_odd_rows(docs_of, odd_rows):
    got = near_duplicates(docs_of(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    want = brute(odd_rows, 85)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and not r.kept
        else:
            assert r.component_id == want[r.doc_id]
    assert {r.doc_id for r in got if r.n_shingles == 0} == {2, 3, 4}


def test_repeated_id_with_two_texts(docs_of):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    got = near_duplicates(docs_of([(7, a), (7, b), (3, a), (9, b)])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(7, 3), (3, 3), (9, 3)}


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([])).collect() == []


def test_signature_agreement_estimates_jaccard():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    s = circulant_signatures([a, b], 512)
    assert abs((s[0] == s[1]).mean() - 1500 / 2500) < 0.08


def test_shingles_and_bands():
    assert len(shingle_set(b"A b c")) == 1 and len(shingle_set(b"a b c d e f")) == 2 and len(shingle_set(b" \t")) == 0
    assert (shingle_set(b"A B c d e") == shingle_set(b"a b\tc  d e")).all()
    assert (1 - 0.85**8) ** bands_for(85) <= 1e-6


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 470)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = components({n: 0 for e in edges for n in e}, edges)
    assert all(want[n] == got.get(n, n) for n in want)
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_labels_meet_each_member_once(docs_of, monkeypatch):
    """Members of many large buckets are joined with their labels as one row, not as one for each bucket."""
    from quire.llm import near_dedup

    seen, write = {}, near_dedup.written

    def note(df, label, *rest):
        return seen.setdefault(label, []).append(out := write(df, label, *rest)) or out

    monkeypatch.setattr(near_dedup, "written", note)
    rows = copies(seed=3, groups=2, size=40)
    got = near_duplicates(docs_of(rows), percent=80).collect()
    members = seen["members"][0]
    assert 0 < members.count() == members.select("node").distinct().count() <= len(rows)
    assert members.selectExpr("max(size(keys)) AS n").first()["n"] > 1
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 80)
