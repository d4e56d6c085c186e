import random
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from clickvault.llm import language
from clickvault.llm.language import codebook, fit, hashed_grams, identify, sample, training_rows
from clickvault.llm.registry import QUERIES

from .helpers import ODD, docs_of, empty

SF = "/root/testdata/sf0.01"


def grams_of(text):
    return np.sort(np.concatenate([*hashed_grams(text.encode(), 3, 20), np.zeros(0, np.int64)])).tolist()


@given(st.lists(st.text("abcé", min_size=1, max_size=6), max_size=6), st.sampled_from([" ", "  ", "7", " ,\n"]))
def test_grams_stay_inside_words(words, between):
    assert grams_of(between.join(words)) == sorted(x for w in words for x in grams_of(w))
    assert grams_of("ABC é") == grams_of("abc É")
    for w in words:  # letters, and with the edges one pair more than letters, and as many triples
        assert len(grams_of(w)) == 3 * len(w) + 1


def test_long_texts_in_parts(monkeypatch):
    text = "some words of some length and more" * 5
    whole = grams_of(text)
    monkeypatch.setattr(language, "STEP", 7)
    assert grams_of(text) == whole


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 30])
def test_codewords_differ(n):
    code = codebook(n)
    assert len({tuple(r) for r in code.tolist()}) == n and (np.abs(code.sum(axis=0, dtype=int)) < n).all()
    if n >= 3:
        assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 2


def test_accuracy_on_held_out(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op7_language_id"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    right = [r.lang_pred == docs[r.doc_id].lang for r in held]
    assert np.mean(right) > 0.97, np.mean(right)
    sure = [x for x, r in zip(right, held) if not r.ambiguous]
    assert np.mean(sure) >= np.mean(right)


def test_odd_rows(spark):
    texts = [*ODD, *["the and of this " * 5] * 6, *["der die und das " * 5] * 6]
    langs = {i: None for i in range(len(ODD))} | {len(ODD) + i: "en" if i < 6 else "de" for i in range(12)}
    df = docs_of(spark, texts, langs)
    model = fit(df)
    assert model.langs == ["de", "en"]
    got = {r.doc_id: r for r in identify(df, model).collect()}
    for i, t in enumerate(texts):
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or "")), (i, got[i])
    assert [got[i].lang_pred for i in range(len(ODD), len(texts))] == ["en"] * 6 + ["de"] * 6
    none = fit(empty(spark))
    assert {r.lang_pred for r in identify(df, none).collect()} == {"und"} and identify(empty(spark), model).count() == 0
    one = fit(df.filter("doc_id >= 9 AND lang = 'en'"))
    assert identify(df, one).filter("doc_id = 10").first().lang_pred == "en"


def test_never_learns_from_held_out(spark):
    df = docs_of(spark, [f"text {'abc' * i}" for i in range(30)])
    kept = [r.doc_id for r in training_rows(df).collect()]
    assert kept and all(zlib.crc32(str(i).encode()) % 3 != 1 for i in kept)


def test_sample_is_bounded_and_fixed(spark):
    rng = random.Random(1)
    df = docs_of(spark, [f"t{rng.random()}" for _ in range(60)], {i: "en" if i % 3 else "fr" for i in range(60)}, extra=False)
    a = sorted(tuple(r) for r in sample(df, 7).collect())
    b = sorted(tuple(r) for r in sample(df.repartition(5), 7).collect())
    assert a == b and len(a) == 14
