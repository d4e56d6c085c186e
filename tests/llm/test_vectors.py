"""Vector codes against a search of every entry in Python integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickvault.llm.vectors import EqualAverage, encode, limit

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    lengths = defaultdict(int)
    for _, v, _ in kept:
        if v and len(v) % parts == 0:
            lengths[len(v)] += 1
    width = max(lengths, key=lambda n: (lengths[n], n), default=0)
    ints = [(i, [math.floor(c * scale) for c in v], lab) for i, v, lab in kept]
    fine = [x for x in ints if width and len(x[1]) == width and max(map(abs, x[1])) <= limit(width)]
    seeds = sorted(fine, key=lambda x: (x[0] is None, x[0] or 0, x[1]))[:entries]
    d = width // parts
    cut = lambda v, p: v[p * d:(p + 1) * d]
    books = [[cut(v, p) for _, v, _ in seeds] for p in range(parts)]

    def near(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = [defaultdict(list) for _ in range(parts)]
        for _, v, _ in fine:
            for p in range(parts):
                groups[p][near(v, p)[1]].append(cut(v, p))
        for p in range(parts):
            for j, members in groups[p].items():
                books[p][j] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, by_label = [], defaultdict(lambda: None)
    for i, v, lab in ints:
        if (i, v, lab) in fine:
            got = [near(v, p) for p in range(parts)]
            code, error = "".join(f"{j:02x}" for _, j in got), sum(far for far, _ in got)
            by_label[lab] = (by_label[lab] or 0) + error
        else:
            code = error = None
        out.append((i, code, error, lab))
    text = ",".join(str(c) for book in books for e in book for c in e)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab], sha) for i, c, e, lab in out), key=str)


def ours(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    for clash in ("part", "entry", "id", "v", "code", "error", "of", "n"):
        df = df.withColumn(clash, F.lit("clash"))
    got = encode(df, **how).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted((tuple(r) for r in got), key=str)


def vectors(rng, n, width, spread=1.0):
    return [[rng.gauss(0, spread) for _ in range(width)] for _ in range(n)]


def test_odd_rows_and_ties_equal_a_search_of_all_entries(spark):
    rng = random.Random(11)
    rows = [(i, v, rng.choice([None, 0, 1])) for i, v in enumerate(vectors(rng, 150, 8))]
    rows += [(3, rows[0][1], 1), (3, rows[0][1], 1), (None, rows[5][1], None), (-7, [0.0] * 8, 2), (-7, [0.0] * 8, 2)]
    rows += [(500, None, 1), (501, [], 1), (502, [1.0] * 7, 1), (503, [1.0] * 12, None), (504, [None] + [1.0] * 7, 1),
             (505, [float("nan")] + [1.0] * 7, 1), (506, [float("inf")] * 8, 1), (507, [1e30] * 8, 1), (508, [-1e-9] * 8, 0)]
    rows += [(600 + i, [float(i % 3)] * 8, 3) for i in range(40)]
    rng.shuffle(rows)
    assert ours(spark, rows, entries=32) == brute(rows, entries=32)


def test_large_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, v, 0) for i, v in enumerate(vectors(rng, 60, 8, 50_000.0))]
    assert ours(spark, rows, entries=8, rounds=2) == brute(rows, entries=8, rounds=2)


def test_fewer_vectors_than_entries_and_empty_table(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 5), (2, [1.0, 2.0, 3.0, 4.5], 5)]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, []) == []
    assert ours(spark, [(1, [], 1), (2, None, 1)]) == brute([(1, [], 1), (2, None, 1)])


@given(st.integers(1, 6), st.integers(1, 300), st.integers(0, 2**32), st.sampled_from([2, 50, 10**8]))
def test_search_finds_the_nearest_entry_of_lowest_index(dim, entries, seed, top):
    rng = np.random.default_rng(seed)
    book, parts = rng.integers(-top, top, (entries, dim)), rng.integers(-top, top, (40, dim))
    found, far = EqualAverage(book).nearest(parts)
    gaps = ((parts[:, None, :] - book[None]).astype(object) ** 2).sum(axis=2)
    assert far.tolist() == [min(g) for g in gaps.tolist()]
    assert found.tolist() == [g.index(min(g)) for g in gaps.tolist()]


def test_search_leaves_entries_out():
    looked = []
    rng = np.random.default_rng(1)
    book = rng.normal(0, 1000, (256, 1)).astype(np.int64)
    search = EqualAverage(book)

    class Seen(np.ndarray):
        pass

    base = search.index
    search.index = base.view(Seen)
    Seen.__getitem__ = lambda self, k: (looked.append(k), np.ndarray.__getitem__(base, k))[1]
    search.nearest(rng.normal(0, 1000, (1, 1)).astype(np.int64))
    blocks = [k for k in looked if isinstance(k, slice)]
    assert 0 < sum(k.stop - k.start for k in blocks) < 100


@pytest.mark.parametrize("parts", [1, 2])
def test_other_parameters(spark, parts):
    rng = random.Random(2)
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(rng, 40, 4))]
    assert ours(spark, rows, parts=parts, entries=5, rounds=3) == brute(rows, parts=parts, entries=5, rounds=3)
