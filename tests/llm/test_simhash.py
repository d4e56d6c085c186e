import random
import re

import xxhash
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickvault.llm import simhash
from clickvault.llm.registry import QUERIES
from clickvault.llm.simhash import BKTree, fingerprint, links, near_duplicates, shard_links, submasks

from .helpers import ODD, docs_of, empty, prose

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, shingle=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps, radius=2):
    """{id: fp} -> {id: smallest id reachable}, all pairs compared."""
    top = {i: i for i in fps}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    ids = sorted(fps)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                p, q = sorted((find(a), find(b)))
                top[q] = p
    return {i: find(i) for i in ids}


@given(st.text(alphabet="abAB É\t\n\x0b\x1cé ", max_size=40))
def test_fingerprint(text):
    assert fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_in_steps():
    text = prose(random.Random(1), 3000)
    assert fingerprint(text.encode(), step=7) == fingerprint(text.encode()) == plain_fingerprint(text)


def test_bk_tree_finds_all():
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = list({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(30)})
    tree = BKTree()
    for x in fps:
        tree.add(x)
    for q in fps[::7]:
        assert sorted(tree.near(q, 2)) == [i for i, x in enumerate(fps) if (x ^ q).bit_count() <= 2]
    groups = shard_links(fps, 2)
    want = plain_components(dict(enumerate(fps)))
    assert all((groups[a] == groups[b]) == (want[a] == want[b]) for a in range(0, len(fps), 5) for b in range(len(fps)))


def test_blocks_meet_every_close_pair():
    parts = submasks(0, 3)
    assert parts[0] | parts[1] | parts[2] == simhash.FULL and sum(p.bit_count() for p in parts) == 64
    deeper = submasks(parts[0], 3)
    assert all(d & parts[0] == parts[0] for d in deeper)


def test_links_when_shards_are_dealt_again(spark):
    """Shards of at most 4: several rounds of smaller blocks, and no link is lost."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre}
    for _ in range(120):
        x = rng.choice(sorted(fps)[:40])
        for _ in range(rng.randrange(1, 4)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(60)})
    df = spark.createDataFrame([(simhash.signed(x), i) for i, x in enumerate(fps)], "fp long, rep long")
    found = [(r.a, r.b) for r in links(df, 2, most=4).collect()]
    want = plain_components(dict(enumerate(fps)))
    top = {i: i for i in range(len(fps))}
    for a, b in found:
        assert want[a] == want[b]
    for _ in range(len(fps)):
        for a, b in found:
            top[a] = top[b] = min(top[a], top[b])
    assert top == want


def test_odd_rows(spark):
    rng = random.Random(7)
    long = prose(rng, 4000)
    texts = [*ODD, long, long + " end", long.upper(), *[prose(rng, 30) for _ in range(30)], "x"]
    df = docs_of(spark, texts)
    got = near_duplicates(df.unionByName(df.filter("doc_id = 3"))).collect()
    fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    want = plain_components(fps)
    assert len(got) == len(texts) + 1
    assert {r.doc_id: r.fp & simhash.FULL for r in got} == fps
    assert {r.doc_id: r.component_id for r in got} == want
    assert near_duplicates(empty(spark)).count() == 0
    nulls = near_duplicates(df.withColumn("doc_id", F.when(F.col("doc_id") != 3, F.col("doc_id"))))
    assert nulls.filter("doc_id IS NULL").count() == 1


def test_op2_whole_table(spark):
    got = QUERIES["op2_simhash_dedup"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{x:016x}" for i, x in fps.items()}
    assert {r.doc_id: r.component_id for r in got} == plain_components(fps)
