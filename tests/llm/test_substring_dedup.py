import numpy as np
import pytest

from quire.llm import substring_dedup as sd


def brute(rows, n=13):
    said = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in said:
        for i in range(len(w) - n + 1) if d is not None else ():
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in said:
        gone = set()
        for i in range(len(w) - n + 1) if d is not None else ():
            if first[tuple(w[i : i + n])] < d:
                gone |= set(range(i, i + n))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def _got(df):
    rows = df.collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in rows), key=str)


@pytest.mark.parametrize("period", range(1, 14))
def test_cover_meets_at_some_shift(period):
    d = sd.difference_cover(period)
    for a in range(period):
        for b in range(period):
            assert any((a + k) % period in d and (b + k) % period in d for k in range(period))


@pytest.mark.parametrize("words,period", [(13, 7), (13, 13), (5, 3), (4, 1)])
def test_passages_at_all_places_match_brute_force(docs_of, monkeypatch, words, period):
    monkeypatch.setattr(sd, "_PACK", 400)  # several runs
    rng = np.random.default_rng(words)
    passages = [[f"p{k}_{i}" for i in range(n)] for k, n in enumerate([words - 1, words, words + 1, 40])]
    rows = []
    for d in range(60):
        w = []
        for _ in range(rng.integers(0, 5)):
            w += [f"x{rng.integers(1 << 30)}" for _ in range(rng.integers(0, 9))]
            w += passages[rng.integers(len(passages))][rng.integers(0, 2) :]
        rows.append((int(rng.integers(1, 50)), " ".join(w)))
    got = _got(sd.without_repeats(docs_of(rows), words, period))
    assert got == brute(rows, words)
    assert sum(r[2] for r in got) > 0


def test_odd_documents(docs_of, odd_rows):
    rows = odd_rows + [(20, "\n".join(["a b c d e f g h i j k l m"] * 3)), (21, "z a b\tc d e f g h i j k l  m z")]
    assert _got(sd.without_repeats(docs_of(rows))) == brute(rows)


def test_empty_table_and_bad_period(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert _got(sd.without_repeats(none)) == []
    with pytest.raises(ValueError):
        sd.without_repeats(none, 5, 6)
