import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickvault.llm.registry import QUERIES
from clickvault.llm.repeats import Level, among, ladder, remove_repeats, repeated_rows, sort_rows, windows

from .helpers import ODD, docs_of, empty, prose

SF = "/root/testdata/sf0.001"


def brute(texts, window):
    """[(n_words, n_removed, kept)] by counting every window's words."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_ladder():
    assert ladder(35, 18) == [18, 35] and ladder(35, 9) == [9, 18, 35] and ladder(5, 9) == [5]


@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 12))
@settings(max_examples=200)
def test_window_keys(words, n):
    lane = np.array([0x1234567, 0xFFFFFFFFFFFFFFF1, 0x8000000000000001], np.uint64)[words]
    keys = windows(lane, n)
    want = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    assert len(keys) == len(want)
    assert len(set(zip(keys.tolist(), want))) == len(set(want)) == len(set(keys.tolist()))


@pytest.mark.parametrize("last", [False, True])
def test_pack_and_sets(last):
    rng = np.random.default_rng(1)
    level = Level(5, last, 7, 40)
    keys = rng.integers(0, 1 << 40, (500, 2 if last else 1), dtype=np.uint64)
    keys = np.concatenate([keys, keys[:50]])
    own, twice = repeated_rows(sort_rows(keys))
    assert len(own) == 500 and twice.sum() == 50
    for b in range(7):
        part = own[level.bucket(own) == b]
        assert (level.unpack(level.pack(part), b) == part).all()
    assert among(keys, own).all() and not among(keys + np.uint64(1), own[:3])[10:].any()


def test_equal_first_halves():
    found = np.array([[5, 1], [5, 2], [5, 9], [7, 1]], np.uint64)
    assert among(np.array([[5, 9], [5, 3], [7, 1], [8, 1]], np.uint64), found).tolist() == [True, False, True, False]


@pytest.mark.parametrize("first,group,bucket,part", [(18, 8 << 20, 4_000_000, 1_000_000), (3, 4000, 700, 300)])
def test_odd_rows(spark, first, group, bucket, part):
    rng = random.Random(4)
    passage = prose(rng, 40)
    texts = [*ODD, *[prose(rng, 60) for _ in range(30)]]
    texts += [prose(rng, rng.randrange(30)) + " " + passage + "\n\n" + prose(rng, rng.randrange(80)) for _ in range(40)]
    texts += [passage] * 30 + [passage + " " + passage, "a b " * 60, " ".join(passage.split()[:34]), prose(rng, 20_000)]
    df = docs_of(spark, texts).repartition(4)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in
                 remove_repeats(df, first=first, group_bytes=group, bucket_windows=bucket, part_windows=part).collect())
    assert got == [(i, *x) for i, x in enumerate(brute(texts, 35))]


def test_empty(spark):
    assert remove_repeats(empty(spark)).count() == 0
    assert remove_repeats(docs_of(spark, [None, ""])).select("n_words").collect() == [(0,), (0,)]


def test_op5_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    want = {r.doc_id: (n, m, hashlib.sha256(k.encode()).hexdigest()) for r, (n, m, k) in zip(rows, brute([r.text for r in rows], 35))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op5_substring_dedup"](spark, SF).collect()}
    assert got == want and sum(m for _, m, _ in want.values()) > 0


def test_known_keys_and_equal_first_halves():
    from clickvault.llm.repeats import Known
    rng = np.random.default_rng(4)
    for width in (1, 2):
        keys = rng.integers(0, 1 << 63, (50_000, width), np.uint64)
        found = sort_rows(keys[:9000])
        assert np.array_equal(Known(found).among(keys), among(keys, found)) and Known(found).among(keys)[:9000].all()
    assert not Known(np.zeros((0, 2), np.uint64)).among(keys).any() and len(Known(found).among(keys[:0])) == 0
    few = rng.integers(0, 30, (4000, 2), np.uint64)
    assert np.array_equal(sort_rows(few), few[np.lexsort(few.T[::-1])])
