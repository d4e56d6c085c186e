import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickvault.llm import personal
from clickvault.llm.personal import KINDS, discover, find, listed, masked

from .helpers import ODD, docs_of, empty, prose

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def passes(kind, s):
    d = [int(c) for c in s if c.isdigit()]
    if kind == 0:
        return True
    if kind == 1:
        return all(int(x) <= 255 for x in s.split("."))
    if kind == 2:
        return 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0
    return 8 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if passes(k, m.group())]


def card(rng, n=16, sep=""):
    d = [rng.randrange(10) for _ in range(n - 1)]
    total = sum(x if i % 2 else 2 * x - 9 * (x > 4) for i, x in enumerate(d[::-1]))
    return sep.join(map(str, [*d, -total % 10]))


def hard_texts():
    rng = random.Random(9)
    texts = [*ODD, "a@b.c%d@e.f.g h@i.j.", "@a.b x@y z@.c q@w.e-r.t", "1.2.3.4.5.6.7.8 300.1.2.3.4 0255.001.2.3 1.2.3", "😀 a.b+c@d-e.fg 日本 10.0.0.1é",
             card(rng), card(rng, 19), card(rng, 17, " "), card(rng, 16, "-") + " 12", "12 " + card(rng), card(rng) + "  " + card(rng), "1" * 40, "+1 (234) 567-8901)) +44. +1 2", "+" * 50 + "12345678",
             "a." * 3000 + "@x.y", "x@" + "a." * 3000 + "b", "1" * 20000, "1." * 5000, "+1" + " " * 5000, card(rng) + card(rng)]
    return texts


def test_base_equals_brute_force(spark):
    texts = hard_texts()
    df = docs_of(spark, texts)
    got = {r.doc_id: r for r in find(df).collect()}
    for i, t in enumerate(texts):
        assert [tuple(s) for s in got[i].base] == brute(t), t[:60] if t else t
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(b[0] == j for b in brute(t)) for j in range(4)]
        assert {tuple(s) for s in got[i].base} <= {tuple(s) for s in got[i].spans}
    assert find(df.unionByName(df)).count() == 2 * len(texts) and find(empty(spark)).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("a1.@+- 90%(é", max_size=40), min_size=8, max_size=30))
def test_random_texts(spark, texts):
    got = {r.doc_id: r for r in find(docs_of(spark, texts, extra=False)).collect()}
    for i, t in enumerate(texts):
        assert [tuple(s) for s in got[i].base] == brute(t), t


def plain_discover(pairs, rounds, least_support, least_conf):
    """The scoring, over (pattern, value, kind) in dictionaries."""
    known = {}
    for _ in range(rounds):
        conf = {}
        for p in {p for p, _, _ in pairs}:
            of = [(v, k) for q, v, k in pairs if q == p]
            mass, support = {}, {}
            for v, k in of:
                kind, score = (k, 1.0) if k is not None else known.get(v, (None, 0))
                if kind is not None:
                    mass[kind] = mass.get(kind, 0) + score
                    support[kind] = support.get(kind, 0) + 1
            for kind, m in mass.items():
                if support[kind] >= least_support and m / (len(of) + 0.5) >= least_conf:
                    conf[p, kind] = m / (len(of) + 0.5)
        doubt = {}
        for p, v, k in pairs:
            if k is None:
                for (q, kind), c in conf.items():
                    if q == p:
                        doubt[v, kind] = doubt.get((v, kind), 1.0) * (1 - c)
        known = {}
        for (v, kind), d in sorted(doubt.items(), key=lambda x: (1 - x[1], -x[0][1])):
            if 1 - d >= least_conf:
                known[v] = (kind, 1 - d)
    return {v: k for v, (k, _) in known.items()}


def test_contexts_find_new_identifiers(spark):
    rng = random.Random(5)
    texts = [f"{prose(rng, 5)} my card number {card(rng)} thanks" for _ in range(12)]
    unseen = "4" * 15 + "3"
    assert not brute(unseen)
    texts += [f"{prose(rng, 5)} my card number {unseen} thanks", f"elsewhere {unseen} alone", "order id 20240101-99 shipped", "order id 77777777 shipped"]
    got = {r.doc_id: r for r in find(docs_of(spark, texts)).collect()}
    for i in (12, 13):
        at = texts[i].index(unseen)
        assert [tuple(s) for s in got[i].spans] == [(2, at, at + 16)] and not got[i].base
    assert not got[14].spans and not got[15].spans
    pairs = [(f"p{a}", f"v{b}", rng.choice([None, None, 0, 2])) for a in range(6) for b in range(12) if rng.random() < 0.5]
    pairs += [("q", f"s{i}", 1) for i in range(9)] + [("q", "n", None), ("r", "n", None)] + [("r", f"m{i}", 1) for i in range(4)] + [("r", "z", None)]
    kinds = {}
    pairs = [(p, v, kinds.setdefault(v, k)) for p, v, k in pairs]
    df = spark.createDataFrame(pairs, "pattern string, value string, kind int")
    for rounds in (1, 3):
        for conf in (0.5, 0.7):
            got = {r.value: r.kind for r in discover(df, rounds, 2, conf).collect()}
            assert got == plain_discover(pairs, rounds, 2, conf)


def test_masked(spark):
    texts = ["call +1 (234) 567-8901 or a@b.c 😀 10.0.0.1!", "none", None, "+1.2.3.4.5678901 x"]
    df = docs_of(spark, texts, extra=False)
    found = find(df).withColumnRenamed("doc_id", "id")
    rows = df.join(found, F.col("doc_id") == F.col("id")).orderBy("doc_id").select(masked(F.col("text"), F.col("spans")).alias("t"), listed("spans").alias("l")).collect()
    assert rows[0].t == "call <PHONE> or <EMAIL> 😀 <IP>!" and rows[1].t == "none" and rows[2].t is None
    assert rows[3].l and re.search(r"\d", rows[3].t) is None and rows[3].t.endswith(" x")


def test_regexes_take_linear_time(spark):
    import time
    t = time.time()
    assert find(docs_of(spark, ["a" * 300_000, "1 " * 150_000, "a@a" * 90_000, "+" + "1 " * 100_000])).count() == 4
    assert time.time() - t < 90
    assert personal.REGEX


def test_any_token_of_a_confident_slot_is_a_candidate(spark):
    rng = random.Random(8)
    texts = [f"{prose(rng, 6)} my card number {card(rng)} thanks" for _ in range(30)] + [f"{prose(rng, 6)} write to {prose(rng, 1)}{i}@host.example soon" for i in range(30)]
    unseen = [("my card number {} thanks", "AB123456", 2), ("write to {}, soon", "user@localhost", 0), ("please write to ({})", "john.doe(at)host", 0), ("my card number: {}", "77", 2)]
    texts += [p.format(v) for p, v, _ in unseen]
    # letters alone: an identifier stands in such slots only, a word of the language elsewhere too
    texts += ["my card number qwertz now", "my card number is", *[f"{prose(rng, 2)} this is {prose(rng, 3)}" for _ in range(9)]]
    got = {r.doc_id: r for r in find(docs_of(spark, texts)).collect()}
    for i, (_, v, kind) in enumerate(unseen, 60):
        at = texts[i].index(v)
        assert [tuple(s) for s in got[i].spans] == [(kind, at, at + len(v))] and not got[i].base, v
    assert [tuple(s) for s in got[64].spans] == [(2, 15, 21)]
    assert all(not got[i].spans for i in range(65, len(texts)))
    assert all(got[i].spans == got[i].base for i in range(60))


def test_chains_and_contexts_of_all_kinds(spark):
    # each identifier teaches the next context: more than three rounds
    pairs = [("p0", f"s{i}", 2) for i in range(256)]
    pairs += [(f"p{step + x}", f"t{step}.{i}", None) for step, n in enumerate((64, 16, 4, 1)) for i in range(n) for x in (0, 1)]
    df = spark.createDataFrame(pairs, "pattern string, value string, kind int")
    assert {r.value: r.kind for r in discover(df, None, 2, 0.3).collect()} == plain_discover(pairs, 50, 2, 0.3) != plain_discover(pairs, 3, 2, 0.3)
    texts = ["tel 12 +1 555 000 1234 or +1 555 000 1235", "at 10.0.0.1 and 10.0.0.2, 10.0.0.3 x@y.zz"]
    got = {(r.rid, r.kind, r.start): r.before for r in personal.places(personal.numbered(docs_of(spark, texts).coalesce(1))).filter("kind IS NOT NULL").collect()}
    assert sorted((k, s, b) for (_, k, s), b in got.items()) == [
        (0, 35, ["0", "3"]), (1, 3, ["^", "at"]), (1, 16, ["1", "and"]), (1, 26, ["0", "2"]), (3, 7, ["tel", "12"]), (3, 26, ["1234", "or"])]


def test_a_long_text_of_many_identifiers(spark):
    """1 MB, 20,000 addresses and 20,000 tokens in one context: rows hold runs of the text, not the text."""
    words = "".join(f"mail user{i}@host{i}.example.com or call desk KX{i:06d}Q now. " for i in range(20_000))
    texts = [words, "or call desk ZZ-9-TOP now", "nothing here", "desk QQ1 only"]
    got = {r.doc_id: r for r in personal.find(docs_of(spark, texts, extra=False)).collect()}
    text = words
    emails = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert got[0].n_email == 20_000 and [(s.start, s.end) for s in got[0].base] == emails
    assert not got[2].spans


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 511, 512, 513, 700])
def test_positions_of_runs_equal_the_whole_text(spark, n):
    rng = random.Random(n)
    text = rng.choice(["", "- ", ">>"]) + "".join(rng.choice(["ab", "é1", "x-y", "Z.9"]) + rng.choice([" ", "  ", ", ", "-", "\n"]) for _ in range(n))
    rows = personal.numbered(docs_of(spark, [text], extra=False))
    got = sorted((r.start, r.value, tuple(r.before)) for r in personal.as_places(personal.positions(rows)).collect())
    words = [(m.start(), m.group().lower()) for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010FFFF]+", text)]
    lower = ["^", "^"] + [w for _, w in words]
    want = []
    for i, (at, _) in enumerate(words):
        if at == 0 or i == 0 or re.search(r'[\x00-\x20\x7F,;:="<>\[\]{}|]', text[words[i - 1][0]:at][len(words[i - 1][1]):] if i else " "):
            body = re.match(r"(?:[!#-+\-./?@\\^_`~]*[0-9A-Za-z\u0080-\U0010FFFF]+)+", text[at:]).group()
            want.append((at, body, (lower[i], lower[i + 1])))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[2] for g in got] == [w[2] for w in want]
    assert all(w[1].startswith(g[1]) for g, w in zip(got, want, strict=True))
