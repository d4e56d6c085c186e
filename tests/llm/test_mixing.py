"""Mixing against a plain sort in Python: targets, expected copies, Pareto order."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from clickvault.llm import mixing
from clickvault.llm.mixing import mix, targets
from tests.llm.helpers import DOCS, ODD, docs_of, empty, prose


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Resharing the excess round by round."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        for s in open_:
            got[s] += left * w[s] / total
        left = 0.0
        for s in list(open_):
            if got[s] >= most * sizes[s]:
                left += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                open_.discard(s)
    return got


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def spark_hash(seed, doc, text):
    h = xxhash.xxh64(seed.to_bytes(4, "little"), 42).intdigest()
    if doc is not None:
        h = xxhash.xxh64(doc.to_bytes(8, "little", signed=True), h).intdigest()
    if text is not None:
        h = xxhash.xxh64(text.encode(), h).intdigest()
    return signed(h)


def factor(sizes, target, most, power):
    """By bisection."""
    lo, hi = 0.0, 1e9
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(most, mid * x ** power) * x for x in sizes) < target else (lo, mid)
    return hi


def brute(rows, power=0.5, seed=13, most=2.0):
    """(source, doc, size) -> taken words, for rows without repeats."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    by = defaultdict(list)
    for (d, t, s), n in zip(rows, size, strict=True):
        by[s].append((d, t, n))
    goal = brute_targets({s: sum(n for *_, n in v) for s, v in by.items()})
    out = Counter()
    for s, members in by.items():
        k = factor([n for *_, n in members], goal[s], most, power)
        ranked, sure = [], 0
        for d, t, n in members:
            e = min(most, k * n ** power) if n else 0.0
            e = round(e) if abs(e - round(e)) < 1e-12 else e
            whole, p = math.floor(e), e - math.floor(e)
            sure += whole * n
            out[(s, d, n, whole * n)] += 0
            u = ((spark_hash(seed, d, t) % (1 << 52)) + 0.5) / (1 << 52)
            ranked.append(((u / (1 - u)) / (p / (1 - p)) if p else math.inf, d, n, whole))
        at, room = 0, goal[s] - sure
        for q, d, n, whole in sorted(ranked, key=lambda r: r[0]):
            take = n > 0 and q < math.inf and at < room and math.floor((room - at) / n + 0.5) >= 1
            out[(s, d, n, (whole + take) * n)] += 1
            at += n if q < math.inf else 0
    return +out


def ours(df, **how):
    return Counter((r.source, r.doc_id, r.size, r.taken) for r in mix(df, **how).collect())


def corpus(seed, n=300):
    rng = random.Random(seed)
    texts = [prose(rng, int(rng.lognormvariate(3, 1.2)) + 1) for _ in range(n)] + ODD
    sources = {i: rng.choice(["a", "a", "a", "b", "c", "é", "zz", None]) for i in range(len(texts))}
    return texts, sources


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bins", [2, 1 << 8])
def test_equals_a_plain_sort(spark, monkeypatch, seed, bins):
    monkeypatch.setattr(mixing, "BINS", bins)
    texts, sources = corpus(seed)
    df = docs_of(spark, texts, sources=sources)
    assert ours(df) == brute([(i, t, sources[i]) for i, t in enumerate(texts)])


def test_words_come_near_targets_and_runs_agree(spark):
    texts, sources = corpus(3, 600)
    df = docs_of(spark, texts, sources=sources)
    rows = mix(df).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mix(df.repartition(7)).collect()))
    longest, taken, goal = defaultdict(int), defaultdict(int), {}
    for r in rows:
        longest[r.source] = max(longest[r.source], r.size)
        taken[r.source] += r.taken
        goal[r.source] = r.target
        assert r.taken == r.copies * r.size <= 2 * r.size and r.certain <= r.copies <= r.certain + 1
    assert all(abs(taken[s] - goal[s]) <= longest[s] / 2 for s in goal)
    assert len({round(r.probability, 6) for r in rows if r.source == "a"}) > 20  # unequal


def test_repeated_rows_are_counted_and_any_of_them_taken(spark):
    rows = [(None, "one two three", "en", "s", 1)] * 500 + [(7, "four five", "en", "s", 1)] * 300 + [(1, "x", "en", "t", 1)] * 50
    got = mix(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter((r.source, r.doc_id) for r in got) == {("s", None): 500, ("s", 7): 300, ("t", 1): 50}
    for s in ("s", "t"):
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 1.5


def test_empty_blank_and_single(spark):
    assert mix(empty(spark)).collect() == []
    blank = mix(docs_of(spark, [None, "", " \t "])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 3
    one = mix(docs_of(spark, ["a b c d"])).collect()
    assert (one[0].target, one[0].taken) == (6.0, 8)


@settings(max_examples=15)
@given(st.dictionaries(st.one_of(st.none(), st.text("abzé\U0001f600", min_size=1, max_size=3)), st.integers(0, 10**6), min_size=1, max_size=9))
def test_targets_equal_resharing_in_rounds(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    want = brute_targets(sizes)
    assert all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6) for s in sizes)
