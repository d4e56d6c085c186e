import random
from collections import Counter
from itertools import combinations

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickvault.llm import quality
from clickvault.llm.quality import chi2_4, consistency, judge, text_stats
from clickvault.llm.registry import QUERIES

from .helpers import ODD, docs_of, empty, prose

SF = "/root/testdata/sf0.01"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_stats(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    cover = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(cover)


@given(st.text("ab \n\t\x0b#|é日\x85\x1c", max_size=60))
def test_statistics(text):
    assert text_stats(text.encode()) == plain_stats(text)


def test_chi_square():
    rng = np.random.default_rng(1)
    x = (rng.standard_normal((400_000, 4)) ** 2).sum(axis=1)
    for p in (0.5, 0.75, 0.99):
        assert abs((x < chi2_4(p)).mean() - p) < 0.003
    near = rng.standard_normal((400_000, 4))
    near = near[(near ** 2).sum(axis=1) < chi2_4(0.75)]
    assert np.allclose(near.var(axis=0) * consistency(0.75), 1, atol=0.03)


def plain_mcd(x, share=0.75, steps=4):
    """Centre and inverse covariance by concentration steps on one array."""
    floors = np.diag(np.square(quality.FLOORS))
    mean = np.median(np.round(x, 3), axis=0)
    cov = np.diag(np.square(1.4826 * np.median(np.abs(np.round(x, 3) - mean), axis=0)))
    for _ in range(steps + 1):
        inv = np.linalg.inv(cov + floors)
        d2 = np.einsum("ni,ij,nj->n", x - mean, inv, x - mean)
        own = x[d2 <= np.sort(d2)[int(np.ceil(share * len(x))) - 1]]
        last = mean, inv
        mean, cov = own.mean(axis=0), np.cov(own.T, bias=True) * consistency(share)
    return last


def fixture(spark):
    rng = random.Random(3)
    texts, langs, sources = [], {}, {}
    for i in range(700):
        n = rng.randrange(60, 300)
        t = prose(rng, n, 3000)
        if i % 10 == 0:
            t = " ".join(f"{w}###" for w in t.split())
        elif i % 35 == 1:
            t = "\n".join([prose(rng, 7, 3000)] * 6) + "\n" + t
        elif i % 35 == 2:
            t = " ".join(w * 5 for w in t.split())
        langs[i], sources[i] = ("en", "hot") if i < 500 else ("fr", f"s{i % 3}") if i < 690 else (None, None)
        texts.append(t)
    return texts, langs, sources


def test_outliers_go_and_the_rest_stays(spark):
    texts, langs, sources = fixture(spark)
    got = {r.doc_id: r for r in judge(docs_of(spark, texts, langs, sources)).collect()}
    for i in range(700):
        odd = i % 10 == 0 or i % 35 in (1, 2)
        assert got[i].kept != odd, (i, got[i])
    # the hot group's distances are those of the estimate on one array
    ids = [i for i in range(500) if not got[i].base_failed]
    x = np.array([[got[i].x1, got[i].x2, got[i].x3, got[i].x4] for i in ids])
    mean, inv = plain_mcd(x)
    want = np.sqrt(np.einsum("ni,ij,nj->n", x - mean, inv, x - mean))
    have = np.array([got[i].distance for i in ids])
    assert np.corrcoef(want, have)[0, 1] > 0.999 and np.abs(want - have).max() < 0.05 * want.max()
    again = {r.doc_id: r.distance for r in judge(docs_of(spark, texts, langs, sources).repartition(7)).collect()}
    assert all(got[i].distance is None or abs(again[i] - got[i].distance) < 1e-5 for i in again)


def exhaustive(x, share=0.75):
    """The least determinant over all subsets of the share of the rows."""
    h, floors = int(np.ceil(share * len(x))), np.diag(np.square(quality.FLOORS))
    return min(np.linalg.det(np.cov(x[list(c)].T, bias=True) * consistency(share) + floors) for c in combinations(range(len(x)), h))


def test_estimate_against_exhaustive_search(spark):
    rng, rows, data = np.random.default_rng(4), [], {}
    for g in range(4):
        n = 12 + g
        x = rng.normal(0, 0.3, (n, 4)) + (np.arange(n) < n // 4)[:, None] * 6.0
        data[f"g{g}"] = x
    # two clusters: the larger one is the estimate
    data["two"] = np.concatenate([rng.normal(0, 0.2, (5, 4)), rng.normal(4, 0.2, (11, 4)) * [1, -1, 1, 0.5]])
    for g, x in data.items():
        rows += [(g, *map(float, v)) for v in x]
    got = {r.grp: r for r in quality.estimate(spark.createDataFrame(rows, "grp string, x1 double, x2 double, x3 double, x4 double").repartition(3)).collect()}
    for g, x in data.items():
        # a step cuts at a bin of distance, so it can keep a row more than the share
        assert got[g].det <= 2.5 * exhaustive(x), (g, got[g].det, exhaustive(x))
        assert got[g].n == len(x)
    assert got["two"].m0 > 3 and all(abs(got[f"g{g}"].m0) < 0.5 for g in range(4))


def test_odd_rows(spark):
    texts = [*ODD, "w " * 60, prose(random.Random(1), 80)]
    df = docs_of(spark, texts, {0: None}, {1: None})
    got = {r.doc_id: r for r in judge(df).collect()}
    for i, t in enumerate(texts):
        n, *rest = plain_stats(t)
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_lines, got[i].n_dup_lines, got[i].n_repeat_words) == (n, *rest)
        assert got[i].base_failed == (n < 50 or 100 * rest[-1] > 50 * n)
    assert got[len(texts) - 1].kept and got[len(texts) - 1].distance < 1e-6 and not got[len(texts) - 2].kept
    assert judge(empty(spark)).count() == 0 and judge(df.unionByName(df)).count() == 2 * len(texts)


def test_labelled_texts(spark):
    got = QUERIES["op9_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter(~F.col("base_failed")).collect()
    assert np.mean([r.kept for r in got if r.quality == 1]) > 0.99
    assert np.mean([not r.kept for r in got if r.quality == 0]) > 0.9
