import random
import re

import pytest
from pyspark.sql import functions as F

from clickvault.llm import leaks, licenses
from clickvault.llm.leaks import decontaminate
from clickvault.llm.licenses import scan

from .helpers import ODD, docs_of, empty, prose

ITEMS = "item_id long, text string, doc_id string, pos string"


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_leaks(texts, items):
    """[(n_words, n_hit, items)]"""
    spans = []
    for i, t in items:
        w = words_of(t)
        n = min(10, len(w))
        spans += [(str(i) if i is not None else "null", tuple(w[a:a + n])) for a in range(len(w) - n + 1)] if w else []
    out = []
    for t in texts:
        w = words_of(t)
        hit, names = set(), set()
        for name, g in spans:
            for a in range(len(w) - len(g) + 1):
                if tuple(w[a:a + len(g)]) == g:
                    hit.update(range(a, a + len(g)))
                    names.add(name)
        out.append((len(w), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("block", [200_000, 40])
def test_leaks(spark, monkeypatch, block):
    monkeypatch.setattr(leaks, "BLOCK", block)
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randrange(10, 40), 60)) for i in range(14)]
    items += [(20, "a a a a a a a a a a a a"), (21, "short one here"), (22, None), (23, "..."), (3, prose(rng, 15)), (24, items[2][1]),
              (None, prose(rng, 12)), (25, "nine words " * 4 + "x")]
    texts = [*ODD, "a " * 30, "SHORT, one-here!", "short one", "nine words nine words nine words nine words x"]
    for k in range(40):
        w = words_of(rng.choice(items)[1]) or ["none"]
        a = rng.randrange(len(w))
        texts.append(prose(rng, rng.randrange(20), 60) + " " + ", ".join(w[a:a + rng.randrange(5, 30)]).upper() + "; " + prose(rng, rng.randrange(20), 60))
    texts.append(prose(rng, 6000, 60))
    df = docs_of(spark, texts)
    given = spark.createDataFrame([(i, t, "clash", "clash") for i, t in items], ITEMS)
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate(df, given).collect()}
    assert got == dict(enumerate(brute_leaks(texts, items)))
    assert sum(h for _, h, _ in got.values()) > 100
    if block > 100:
        assert decontaminate(df.unionByName(df), given).count() == 2 * len(texts)
        assert decontaminate(empty(spark), given).count() == 0
        assert decontaminate(df, given.limit(0)).filter("contaminated OR n_items > 0").count() == 0


def brute_base(text):
    w = words_of(text)
    found = [(a, label) for phrase, label in licenses.PHRASES for a in range(len(w)) if w[a:a + len(phrase.split())] == phrase.split()]
    at = [a for a, _ in found]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


@pytest.mark.parametrize("block", [200_000, 500])
def test_licenses(spark, monkeypatch, block):
    monkeypatch.setattr(licenses, "BLOCK", block)
    rng = random.Random(6)
    lines = [t for _, t in licenses.TEMPLATES] + [p for p, _ in licenses.PHRASES]
    texts = [*ODD, "CC-BY-NC", "cc by nc cc by nc", "under the MIT licence", "Under-the\nMIT/License " * 300, *lines]
    texts += [prose(rng, rng.randrange(60)) + "\n" + rng.choice(lines) + " " + prose(rng, rng.randrange(60)) for _ in range(40)]
    long = "this work is licensed quite freely under the gnu general public license version 3"
    broken = "this work is licensed by some and other terms than the gnu has"
    texts += [long, broken]
    df = docs_of(spark, texts)
    got = {r.doc_id: r for r in scan(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r.score <= 1
    for label, line in licenses.TEMPLATES:
        i = texts.index(line)
        assert label in got[i]["labels"].split(",") and got[i].score == 1
    n = len(texts)
    assert got[n - 2]["labels"] == "gpl-3" and got[n - 1]["labels"] == "" and got[3]["labels"] == ""
    if block > 100:
        assert scan(empty(spark)).count() == 0 and scan(df.unionByName(df)).count() == 2 * n
        assert scan(df, templates=[], phrases=[]).filter("labels <> ''").count() == 0
        assert scan(df.withColumn("doc_id", F.lit(None).cast("long"))).count() == n


def test_phrases_shorter_than_a_gram(spark):
    from clickvault.llm.licenses import scan as license_scan
    texts = ["this is GPL v3 code, gpl-v3!", "gpl v2", "zlib", None, "v3", "under the MIT license"]
    got = {r.doc_id: r for r in license_scan(docs_of(spark, texts), templates=[("isc", "ISC notice")],
                                             phrases=[("gpl v3", "gpl-3"), ("zlib", "zlib"), ("under the mit license", "mit")]).collect()}
    assert [(got[i].n_base, got[i].first_word, got[i].last_word, got[i].base_labels) for i in range(6)] == [
        (2, 2, 5, "gpl-3"), (0, None, None, ""), (1, 0, 0, "zlib"), (0, None, None, ""), (0, None, None, ""), (1, 0, 0, "mit")]
    (own,) = license_scan(docs_of(spark, ["the isc notice here"]), templates=[("isc", "ISC notice")], phrases=[]).collect()
    assert own.labels == "isc" and [tuple(s) for s in own.spans] == [(1, 3, "isc", 1.0)]


def test_whole_licences_with_edits(spark):
    from clickvault.llm import license_texts as T
    rng = random.Random(11)
    around = lambda t: prose(rng, 30) + "\n" + t + "\n" + prose(rng, 30)
    edited = [(label, around(t)) for label, t in T.WHOLE]
    edited.append(("mit", around(T.MIT.replace("AUTHORS OR COPYRIGHT HOLDERS", "ACME CORPORATION OF SPRINGFIELD"))))
    edited.append(("mit", around(T.MIT.replace("and to permit persons to\nwhom the Software is furnished to do so, ", ""))))  # a dropped clause
    edited.append(("bsd", around(T.BSD_3.replace("the copyright holder nor", "Acme Corporation Limited nor"))))
    edited.append(("bsd", around(T.BSD_3.replace(T._BSD_THIRD, ""))))
    edited.append(("zlib", around(T.ZLIB.replace(" If you use\nthis software in a product, an acknowledgment in the product documentation would be appreciated but is not required.", ""))))
    edited.append(("isc", around(T.ISC.replace("\n", "\n * ").lower())))
    few = lambda t, share: " ".join(t.split()[:int(len(t.split()) * share)])
    edited.append(("", around(few(T.ISC, 0.6))))
    edited.append(("", around(few(T.UNLICENSE, 0.6))))
    twice = T.MIT + "\n" + T.MIT
    texts = [t for _, t in edited] + [twice]
    got = {r.doc_id: r for r in scan(docs_of(spark, texts)).collect()}
    for i, (label, text) in enumerate(edited):
        # the opening lines are templates of their own, under the same labels
        assert got[i].labels == label, (text, got[i].labels)
    whole = [s for s in got[len(texts) - 1].spans if s.hi - s.lo > 100]
    n = len(words_of(T.MIT))
    assert [(s.lo, s.hi, s.label, s.covered) for s in whole] == [(0, n, "mit", 1.0), (n, 2 * n, "mit", 1.0)]
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate([*texts, None, "mit"])))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    twin = con.execute(f"SELECT {', '.join(names)} FROM ({licenses.oracle_sql()}) WHERE doc_id < {len(texts)} ORDER BY doc_id").fetchall()
    assert twin == [tuple(got[i][c] for c in names) for i in range(len(texts))]
