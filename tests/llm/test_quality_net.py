import random
import zlib

import numpy as np
import pytest

from quire.llm.quality_net import Net, Settings, _index_vectors, quality_scores, word_table

SMALL = Settings(buckets=1 << 10, dims=16, hidden=8, epochs=60)


def made(n=500):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        w = [rng.choice(["river", "mill", "boat", "light", "sea", "road"]) for _ in range(rng.randrange(8, 60))]
        rows.append((i, " ".join(w) if good else " ".join(x.upper() + "!!" for x in w)))
        labels.append((i, int(good), None))
    return rows, labels


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, score string")


def test_held_out_accuracy(spark, docs_of):
    rows, labels = made()
    got = quality_scores(docs_of(rows), labels_of(spark, labels), s=SMALL).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.predicted == (r.doc_id % 3 > 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_held_out_labels_are_not_used(spark, docs_of):
    rows, labels = made(200)
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, s) for i, q, s in labels]
    a, b = (sorted(quality_scores(docs_of(rows), labels_of(spark, x), s=SMALL).collect()) for x in (labels, wrong))
    assert a == b


def test_context_sums_as_brute_force(docs_of):
    rows = [(1, "a b c a"), (2, "c c"), (3, None), (4, ""), (5, "x")]
    got = word_table(docs_of(rows).repartition(3), SMALL)
    places, signs = _index_vectors(SMALL)
    bucket = lambda w: zlib.crc32(w.encode()) & (SMALL.buckets - 1)
    want = np.zeros((SMALL.buckets, SMALL.dims + 1))
    for _, t in rows:
        w = [bucket(x) for x in (t or "").split()]
        for i, x in enumerate(w):
            want[x, -1] += 1
            for j in range(max(0, i - 2), min(len(w), i + 3)):
                if j != i:
                    want[x, places[w[j]]] += signs[w[j]]
    assert (got == want).all()


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = Net(x, y, np.arange(3000) % 5 == 0, SMALL)
    p = net.scores(x)
    for lo in (0.1, 0.4, 0.7):
        part = (p >= lo) & (p < lo + 0.2)
        assert abs(p[part].mean() - y[part].mean()) < 0.1


def test_gradients():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(20, 3)), (rng.random(20) < 0.5).astype(float)
    net = Net(x, y, np.zeros(20, bool), Settings(hidden=4, epochs=0))
    loss = lambda: np.mean(np.logaddexp(0, -(2 * y - 1) * (np.tanh(x @ net.p[0] + net.p[1]) @ net.p[2] + net.p[3])))
    g = net._gradients(x, y)[0][1, 2] - 1e-4 * net.p[0][1, 2]
    before = loss()
    net.p[0][1, 2] += 1e-6
    assert (loss() - before) / 1e-6 == pytest.approx(g, abs=1e-5)


def test_odd_rows(spark, docs_of, odd_rows):
    labels = labels_of(spark, [(1, 1, None), (1, 0, None), (2, None, None), (None, 1, None), (5, 1, None), (11, 0, None), (777, 1, None)])
    got = quality_scores(docs_of(odd_rows), labels, s=SMALL).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in odd_rows)
    assert all(0 <= r.score <= 1 for r in got)
    none = quality_scores(docs_of(odd_rows), labels.limit(0), s=SMALL).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 0)}
    assert quality_scores(docs_of([]), labels, s=SMALL).collect() == []


def test_tables_do_not_hang_on_the_runs(docs_of, monkeypatch):
    """The whole table is added to once for some megabytes of text; the counts are the same by shorter runs."""
    from quire.llm import quality_net

    assert quality_net._COUNTED >= 4 << 20
    df = docs_of([(i, f"one two{i % 7} three, four {i}") for i in range(300)])
    want = quality_net.word_table(df)
    monkeypatch.setattr(quality_net, "_COUNTED", 100)
    assert want[:, -1].sum() > 0 and (quality_net.word_table(df) == want).all()
