import hashlib
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from quire.llm.importance import crc32_many, resampled

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, target, share=10, least=20, buckets=10_000):
    place = lambda w: zlib.crc32(w.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for rows, count in ((docs, s), ([(0, x) for x in target], t)):
        for _, text in rows:
            for w in _words(text):
                count[place(w)] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (S + buckets) / ((a + 1) * (T + buckets)))) for a, b in zip(s, t)]
    out = []
    for d, text in docs:
        w = _words(text)
        weight = sum(gain[place(x)] for x in w) // len(w) if w else 0
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(w), weight, score, None])
    may = sorted((r for r in out if r[0] is not None and r[1] >= least), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(may[: len(may) * share // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=str)


def _got(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_crc_of_any_length():
    rng = np.random.default_rng(1)
    words = [rng.bytes(n) for n in [0, 1, 2, 3, 4, 5, 63, 64, 65, 127, 128, 129, 1000, 70_000] for _ in range(3)]
    assert crc32_many(words).tolist() == [zlib.crc32(w) for w in words]
    assert crc32_many([]).tolist() == []


def test_odd_documents_match_brute_force(spark, docs_of, odd_rows):
    rng = np.random.default_rng(3)
    rows = [(i + 100, " ".join(f"w{k}" for k in rng.integers(0, 300, rng.integers(0, 60)))) for i in range(80)] + odd_rows
    target = ["w1 w2 w3, W4 w5", None, "", "the river ran"]
    got = _got(resampled(docs_of(rows), spark.createDataFrame([(x,) for x in target], "text string"), share=30))
    assert got == brute(rows, target, share=30)
    assert any(r[4] for r in got)


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert _got(resampled(none, none)) == []
    rows = [(1, "a b c " * 10), (2, None)]
    assert _got(resampled(docs_of(rows), none, share=100)) == brute(rows, [], share=100)


def test_repeated_rows_and_ties_get_places_of_their_own(spark, docs_of):
    rows = [(5, "one two three four " * 5)] * 40 + [(6, "one two three four " * 5)]
    got = resampled(docs_of(rows), docs_of(rows), share=50).filter(F.col("rank").isNotNull())
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, 21))


def test_longer_runs_of_words_are_features(spark, docs_of):
    got = resampled(docs_of([(1, "a b c")]), docs_of([(1, "a b c")]), most=2).first()
    assert (got["n_features"], got["n_words"]) == (5, 3)
