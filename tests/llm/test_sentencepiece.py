import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from quire.llm.sentencepiece_dropout import MODEL, DropoutModel, decode, encode, load

sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TEXT = st.text(st.sampled_from(list("abeont hTé𝄞▁\n\t ")), max_size=40)


def ids_of(m, b):
    return np.frombuffer(b, m.dtype).tolist()


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(0, 9))
def test_round_trip(text, key):
    m = load(MODEL, 0.3, 7, 4)
    assert m.decode(m.encode(text, key)).decode() == text


@settings(max_examples=200, deadline=None)
@given(TEXT.filter(lambda t: "▁" not in t))
def test_without_dropout_as_the_library(text):
    m = load(MODEL, 0.0, 0, 1)
    assert ids_of(m, m.encode(text, 0)) == sp.encode(text)


def test_words_together_as_one_by_one():
    m, rng = DropoutModel(MODEL, 0.2, 5, 3), random.Random(2)
    words = ["".join(rng.choices("theonrisat.,éß▁", k=rng.randrange(0, 30))) for _ in range(2000)] + ["\nthe", "\n", "\u0000a"]
    words = [w for w in words if "▁" not in w]
    got = m.segment_many(words, 1)
    assert [ids_of(m, g) for g in got] == [m.segment(w, 1) for w in words]


def test_dropout_varies_and_repeats():
    a, b = DropoutModel(MODEL, 0.3, 5, 4), DropoutModel(MODEL, 0.3, 5, 4)
    text = "internationalization of understanding " * 40
    assert a.encode(text, 1) == b.encode(text, 1)
    assert a.encode(text, 1) != a.encode(text, 2)
    assert DropoutModel(MODEL, 0.3, 6, 4).encode(text, 1) != a.encode(text, 1)
    assert len(a.encode(text, 1)) > len(DropoutModel(MODEL, 0.0, 5, 1).encode(text, 1))


def test_every_occurrence_is_cut_on_its_own(docs_of):
    text = " ".join(["internationalization"] * 400)
    ids = [tuple(np.frombuffer(r.ids, "<u2").tolist()) for r in encode(docs_of([(1, text)]), dropout=0.3).collect()][0]
    m = load(MODEL, 0.3, 7)
    whole = [tuple(ids_of(m, m.segment_many(["internationalization"], p)[0])) for p in m.places(0, 400)]
    assert len(set(whole)) > 40
    starts = [k for k, i in enumerate(ids) if m.raw[i].startswith(b" ")]
    assert len({ids[a:b] for a, b in zip(starts, [*starts[1:], len(ids)])}) > 40


def test_kept_pieces_as_one_by_one():
    m, rng = DropoutModel(MODEL, 0.2, 5), random.Random(3)
    words = ["".join(rng.choices("theonrisat.,éß𝄞", k=rng.randrange(1, 40))) for _ in range(300)] + ["the", "and", "station"] * 200
    for key in (0, 77, (1 << 32) - 1):
        want = [i for w, p in zip(words, m.places(key, len(words)).tolist()) for i in m.segment(w, p)]
        assert ids_of(m, m.encode(" ".join(words), key)) == want


def test_share_of_skipped_merges():
    m = DropoutModel(MODEL, 0.1, 9, 1)
    words = [f"{a}{b}" for a in "abcdefghijklmnop" for b in ("he", "in", "on", "er", "at")]
    plain = DropoutModel(MODEL, 0.0, 9, 1)
    changed = sum(m.segment(w, 0) != plain.segment(w, 0) for w in words)
    assert 0 < changed < len(words) // 2


def test_odd_rows(docs_of, odd_rows):
    back = decode(encode(docs_of(odd_rows))).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in odd_rows)
    assert all(len(r.ids) == 2 * r.n_pieces for r in back)
    same = [r.ids for r in back if r.doc_id == 5]
    assert same[0] == same[1]
    assert decode(encode(docs_of([]))).collect() == []


def test_bad_settings():
    with pytest.raises(ValueError):
        DropoutModel(MODEL, 1.0, 0, 1)
