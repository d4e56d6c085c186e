"""Collocations against counters in Python; the counting code also window by window."""

import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from clickvault.llm import phrases
from clickvault.llm.phrases import Hasher, close, collocations
from tests.llm.helpers import ODD, docs_of, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def brute(rows, least, longest=5, top=2000):
    f, total = {}, Counter()
    for text, lang in rows:
        for w in pieces(text):
            total[lang] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i:i + n])] = f.get((lang, tuple(w[i:i + n])), 0) + 1
    f = {k: n for k, n in f.items() if n >= least}
    out = []
    for (lang, w), a in f.items():
        if len(w) == 1:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        covered = any(g == lang and len(v) > len(w) and b >= a and any(v[i:i + len(w)] == w for i in range(len(v)))
                      for (g, v), b in f.items())
        if not covered:
            score, _, left, right = min(cuts)
            out.append((lang, " ".join(w), a, left, right, total[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(mine)]
    return sorted(ranked)


def corpus(seed, n=250):
    rng = random.Random(seed)
    vocab = ["The", "of", "Ärger", "x", "über\x0b", "日本", "a", "b", "c", "new", "york", "city", "\xa0"] + [f"w{i}" for i in range(30)]
    fixed = ["New York city hall", "a a a a a a", "one two three four five six"]

    def text():
        out = []
        for _ in range(rng.randrange(1, 40)):
            out.append(rng.choice(fixed) if rng.random() < 0.1 else rng.choice(vocab))
            out.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r"]))
        return "".join(out)

    return [text() for _ in range(n)] + ODD, {i: rng.choice(["en", "en", "de", None, "und"]) for i in range(n + len(ODD))}


def ours(df, **how):
    return sorted(tuple(r) for r in collocations(df, bits=18, **how).collect())


@pytest.mark.parametrize("fraction", [0.0, 0.3])
def test_equals_counters_whatever_the_sample_holds(spark, fraction):
    texts, langs = corpus(1)
    want = brute([(t, langs[i] or "und") for i, t in enumerate(texts)], least=4, top=40)
    assert len(want) > 40
    assert ours(docs_of(spark, texts, langs=langs), least=4, top=40, fraction=fraction) == want


def test_a_small_bit_table_only_costs_work(spark):
    texts, langs = corpus(2, 80)
    want = brute([(t, langs[i] or "und") for i, t in enumerate(texts)], least=5)
    got = collocations(docs_of(spark, texts, langs=langs), least=5, bits=6, fraction=0.2).collect()
    assert sorted(tuple(r) for r in got) == want


def test_border_failures_are_followed_to_the_end(spark):
    """An empty proposal: every pair is a failure of the border."""
    texts = ["p q r s t"] * 10
    df = docs_of(spark, texts)
    rows = [(r.phrase, r.a) for r in collocations(df, least=10, bits=12, fraction=0.0).collect()]
    assert rows == [("p q r s t", 10)]


def test_exact_beyond_64_bits(spark):
    big = 3 * 10**12
    found = spark.createDataFrame([("en", "a b", 2, big)], "lang string, phrase string, words int, n long")
    singles = spark.createDataFrame([("en", "a", big), ("en", "b", big)], "lang string, word string, n long")
    totals = spark.createDataFrame([("en", 7 * 10**12 + 1)], "lang string, n long")
    row = phrases.score(found, singles, totals, 100).collect()[0]
    assert row.score == 1000 * big * (7 * 10**12 + 1) // (big * big)


def test_empty_tables(spark):
    assert ours(empty(spark)) == []
    assert ours(docs_of(spark, ODD), least=1)[0][0] == "en"
    assert ours(docs_of(spark, [None, "", "one", "... , ;"]), least=1) == []


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([7] * len(texts), pa.int64()),
                                       pa.array(["en"] * len(texts))], names=["text", "lang_hash", "lang"])


@given(st.lists(st.one_of(st.none(), st.text("aB .\n\té日", max_size=40)), max_size=12), st.integers(1, 20), st.integers(5, 12))
def test_windows_and_flushes_change_nothing(texts, window, flush):
    old = phrases.WINDOW, phrases.FLUSH
    phrases.WINDOW, phrases.FLUSH = window, flush
    try:
        words = Counter()
        for got in phrases._count_words(3)(iter([batch_of(texts)])):
            for r in got.to_pylist():
                words[r["word"].decode()] += r["n"]
        assert words == Counter(w for t in texts for p in pieces(t) for w in p)
        everything = SimpleNamespace(value=np.full(8, 255, np.uint8))
        counts = Counter()
        for got in phrases._count_phrases(3, 4, 6, everything)(iter([batch_of(texts[:5]), batch_of(texts[5:])])):
            for r in got.to_pylist():
                counts[r["words"], r["head"], r["last"]] += r["n"]
        want = Counter(tuple(p[i:i + n]) for t in texts for p in pieces(t) for n in (2, 3, 4) for i in range(len(p) - n + 1))
        assert sorted((k[0], n) for k, n in counts.items()) == sorted((len(k), n) for k, n in want.items())
    finally:
        phrases.WINDOW, phrases.FLUSH = old


def test_word_hashes_depend_on_the_bytes_alone():
    data = np.frombuffer(b"abc xabc abcabc \x00 \x00\x00", np.uint8)
    h = Hasher(1).words(data, np.array([0, 5, 9, 12, 16, 18]), np.array([3, 8, 12, 15, 17, 20]))
    assert len(set(h[:4].tolist())) == 1 and len(set(h[3:].tolist())) == 3


def test_close_leaves_out_what_has_an_unknown_part(spark):
    texts = docs_of(spark, ["a b"] * 5, extra=False).selectExpr("text", "xxhash64('en') AS lang_hash", "'en' AS lang")
    nothing = spark.createDataFrame([(1,)], "h long")
    assert close(texts, nothing, 2, 5, 3, 16, "t").collect() == []
