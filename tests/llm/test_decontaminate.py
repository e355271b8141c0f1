import random

import numpy as np
import pytest

from quire.llm.decontaminate import GAP, MATCH, MISMATCH, align, contaminated, most, word_hashes


def brute_score(a, b):
    best, prior = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, prior[j - 1] + (MATCH if x == y else MISMATCH), prior[j] + GAP, row[-1] + GAP))
        best, prior = max(best, *row), row
    return best


def test_alignment_as_brute_force():
    rng = random.Random(5)
    pairs = [([rng.randrange(1, 6) for _ in range(rng.randrange(1, 25))], [rng.randrange(1, 6) for _ in range(rng.randrange(1, 60))])
             for _ in range(200)]
    score, end = align([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    assert score.tolist() == [brute_score(a, b) for a, b in pairs]
    for (a, b), s, e in zip(pairs, score, end):
        assert s == 0 or brute_score(a, b[: e + 1]) == s


def test_bound_is_never_under_the_score():
    rng = random.Random(6)
    for _ in range(300):
        a, b = ([rng.randrange(1, 30) for _ in range(rng.randrange(1, n))] for n in (25, 60))
        assert brute_score(a, b) <= most(np.array(a, np.uint64), np.array(b, np.uint64)) <= MATCH * len(a)


@pytest.mark.parametrize("every", [5, 6, 7, 8])
def test_edited_copies_beside_exact_ones(spark, docs_of, every):
    item = [f"w{k}" for k in range(48)]
    edited = [f"new{k}" if (k + 1) % every == 0 or k == 47 else w for k, w in enumerate(item)]
    around = [f"x{k}" for k in range(20)]
    docs = [(k, " ".join(around + item + around)) for k in range(3)] + [(9, " ".join(around + edited + around))]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in contaminated(docs_of(docs), bench).collect()}
    assert got == {0: 96, 1: 96, 2: 96, 9: brute_score(item, edited)}


@pytest.fixture(scope="module")
def made():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(3000)}"
    items = {k: [word() for _ in range(rng.randrange(25, 60))] for k in range(12)}
    items[50] = ["only", "three", "words"]
    docs, want = [], set()
    for i in range(160):
        text = [word() for _ in range(rng.randrange(30, 300))]
        if i % 4 == 0:
            k = rng.randrange(12)
            copy = list(items[k])
            for _ in range(len(copy) // 12):  # replaced, lost and added words
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[word()], [], [copy[at], word()]])
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() + "," for w in copy]
            want.add((i, k))
        elif i % 4 == 1:  # two thirds of the table share one item: no seed is rare
            text[5:5] = items[3]
            want.add((i, 3))
        docs.append((i, " ".join(text)))
    docs.append((900, "x only three words y"))
    want.add((900, 50))
    return docs, items, want


def test_copies_are_found(spark, docs_of, made):
    docs, items, want = made
    bench = spark.createDataFrame([(k, " ".join(w), "x") for k, w in items.items()], "item_id long, text string, df string")
    got = contaminated(docs_of(docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    sets = dict(docs)
    for r in got[:20]:
        a, b = (word_hashes(t.encode()).tolist() for t in (" ".join(items[r.item_id]), sets[r.doc_id]))
        assert r.score == brute_score(a, b) and abs(r.similarity - r.score / (MATCH * len(a))) < 1e-12


def test_odd_rows(spark, docs_of, odd_rows):
    bench = spark.createDataFrame([(1, odd_rows[0][1]), (2, None), (3, ""), (None, "é ü 𝄞"), (4, odd_rows[0][1])], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs_of(odd_rows), bench).collect()}
    assert {i for i, k in got if k == 1} == {i for i, k in got if k == 4} == {1, None, 5, 10, 11}
    assert (12, None) in got
    assert contaminated(docs_of([]), bench).collect() == []
    assert contaminated(docs_of(odd_rows), bench.limit(0)).collect() == []
