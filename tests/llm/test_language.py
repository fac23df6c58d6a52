import numpy as np
import pandas as pd
import pytest

from carelattice.llm import language_id as L
from carelattice.llm import queries
from tests.llm.helpers import by_id, documents

TEXTS = ["the cat and the dog", "der Hund und die Katze", "the end of the day", "und der Tag", None, "", "123 !?", "É"]
LANGS = ["en", "de", "en", "de", "en", None, "de", None]


def naive(text, dims):
    """The sum of bound trigrams, one position after the other."""
    codes, gap = [0], True
    for c in text.lower():
        if c.isalpha():
            codes.append(ord(c))
            gap = False
        elif not gap:
            codes.append(0)
            gap = True
    if codes[-1]:
        codes.append(0)
    v = {c: np.random.default_rng(c).choice(np.array([-1, 1], np.float32), dims) for c in set(codes)}
    total = np.zeros(dims)
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        total += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    return total


def test_bundles_equal_naive_sums():
    for text in TEXTS[:4] + ["a", "x" * 50, "ÀÉ ß ǅ 中文字"]:
        assert np.allclose(L.encoder(256).bundle(*L.trigrams(text)), naive(text, 256))


def test_steps_do_not_change_a_long_text(monkeypatch):
    text = "Wörter, die 12 sehr lang sind - und noch mehr. " * 40
    whole = L.trigrams(text)
    monkeypatch.setattr(L, "_STEP", 37)
    parts = L.trigrams(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_profiles_and_cosines_equal_brute_force(spark):
    docs = documents(spark, TEXTS, LANGS)
    known = L.profiles(docs, dims=256)
    assert sorted(known) == ["de", "en"]
    for lang in known:
        want = sum(naive(t, 256) for t, x in zip(TEXTS, LANGS) if x == lang and t)
        assert np.allclose(known[lang], want)
    got = {r["doc_id"]: r for r in L.classify(docs, known, dims=256).collect()}
    for i, text in enumerate(TEXTS):
        vector = naive(text or "", 256)
        if not any(c.isalpha() for c in text or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        cosines = {x: float(vector @ known[x] / np.linalg.norm(vector) / np.linalg.norm(known[x])) for x in known}
        best = max(sorted(cosines), key=cosines.get)
        assert got[i]["lang_pred"] == best and got[i]["score"] == pytest.approx(max(0, cosines[best]))


def test_empty_null_and_repeated(spark):
    empty = documents(spark, []).limit(0)
    assert L.profiles(empty) == {}
    assert L.classify(empty, {}).collect() == []
    docs = documents(spark, [(None, "the cat"), (1, "the cat"), (1, "the cat"), (2, None)])
    assert [r[1:] for r in by_id(L.classify(docs, {}), "doc_id", "lang_pred", "score")] == [("und", 0.0)] * 4
    known = L.profiles(documents(spark, ["the cat", "le chat"], ["en", "fr"]))
    got = by_id(L.classify(docs, known), "doc_id", "lang_pred")
    assert got == [(1, "en"), (1, "en"), (2, "und"), (None, "en")]
    assert L.identified(docs, known).count() == 3
    assert L.identified(docs, known).columns == docs.columns


def test_held_out_accuracy_and_contract(spark, sf_dir):
    got = queries.op1_language(spark, "/root/testdata/sf0.01").toPandas()
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    assert (both.lang_pred == both.lang)[both.held_out].mean() > 0.98
