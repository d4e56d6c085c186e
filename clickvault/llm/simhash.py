"""SimHash near-duplicates: fingerprints, BK-trees over shards, components.

Fingerprint: 64 bits, a bit is 1 if set in over half of the XXH64 (seed 42)
of the text's word shingles, repeats included.

Search: equal fingerprints are one. The others are dealt into shards so that
two within the radius meet in at least one: 64 bits in ``radius + 1`` blocks,
one of which must agree. A shard is the fingerprints that agree on a set of
bits (a mask). A shard of more than ``most`` is dealt again by the bits that
are still free, cut into ``radius + 1`` blocks, so no shard grows with the
corpus: what agrees on all but a few bits has few different fingerprints.

In each shard a BK-tree is built: a node's children are keyed by their
integer Hamming distance to it; a search follows only the edges within the
radius of its own distance. Each shard's links come out as a star of each
connected group (at most one link a fingerprint), never as all pairs.

The trees are not broadcast by the driver: together they hold the
fingerprints of all documents, which has no size bound. Each shard's tree is
built where the shard's fingerprints, its only queries, were shuffled to.

Null or wordless text: fingerprint zero, linked like any other. Repeated rows
share their id's row result; a null id gets a component like any other row
with its fingerprint, and is its smallest only if it is alone there. Texts of
fewer words than a shingle are one shingle. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import batched, columns_of, map_texts, materialize, pick
from clickvault.llm.components import components

BITS = 64
FULL = (1 << BITS) - 1
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42, step: int = 1 << 16) -> int:
    """SimHash of a whole text given in UTF-8; counts are kept in steps, so a long text needs little memory."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: A-Z only, and exactly the six white-space characters
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, step):
        h = np.array([xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[i:i + step], ends[i:i + step], strict=True)], ">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed 64-bit integer, one row per input row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = columns_of(batch, id_col, text_col)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()),
                                              pa.array([signed(fingerprint(t or b"", shingle)) for t in texts], pa.int64())], schema=schema)

    return map_texts(pick(docs, id_col, text_col), run, "doc_id long, fp long")


def submasks(mask: int, parts: int) -> list[int]:
    """``mask`` and one block more of the free bits, for each of ``parts`` blocks."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False) if hi > lo]


class BKTree:
    """Fingerprints under their Hamming distance; children keyed by the distance to the parent."""

    def __init__(self):
        self.value: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        self.value.append(x)
        self.children.append({})
        at, new = 0, len(self.value) - 1
        while at != new:
            at = self.children[at].setdefault((self.value[at] ^ x).bit_count(), new)

    def near(self, x: int, radius: int) -> list[int]:
        """The nodes within ``radius`` of ``x``."""
        found, todo = [], [0] if self.value else []
        while todo:
            at = todo.pop()
            d = (self.value[at] ^ x).bit_count()
            if d <= radius:
                found.append(at)
            todo += [c for e, c in self.children[at].items() if d - radius <= e <= d + radius]
        return found


def shard_links(fps: list[int], radius: int) -> list[int]:
    """For each fingerprint of a shard, the index of the one that stands for its group."""
    tree, top = BKTree(), list(range(len(fps)))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for i, x in enumerate(fps):
        for j in tree.near(x, radius):
            top[find(j)] = find(i)
        tree.add(x)
    return [find(i) for i in range(len(fps))]


def shards(fps: DataFrame, radius: int, most: int) -> DataFrame:
    """``mask, key, members``: shards of 2 to ``most`` fingerprints (``fp``, ``rep``)."""
    todo, masks, done = fps.withColumn("mask", F.lit(0).cast("long")), [0], None
    while masks:
        parts = {m: submasks(m, radius + 1) for m in masks}
        deeper = F.create_map(*[x for m, s in parts.items() for x in (F.lit(signed(m)), F.array(*[F.lit(signed(y)) for y in s]))])
        dealt = todo.select("fp", "rep", F.explode(deeper[F.col("mask")]).alias("mask"))
        dealt = dealt.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = materialize(dealt.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-sizes")
        small = sizes.filter(F.col("n") <= most).select("mask", "key")
        lists = dealt.join(small, ["mask", "key"]).groupBy("mask", "key").agg(F.sort_array(F.collect_list(F.struct("rep", "fp"))).alias("members"))
        done = lists if done is None else done.unionByName(lists)
        masks = [r[0] & FULL for r in sizes.filter(F.col("n") > most).select("mask").distinct().collect()]  # at most (radius + 1)^level
        if masks:
            todo = materialize(dealt.join(sizes.filter(F.col("n") > most).select("mask", "key"), ["mask", "key"], "left_semi")
                               .select("fp", "rep", "mask"), "simhash-large")
    return done


def links(fps: DataFrame, radius: int = 2, most: int = 1024) -> DataFrame:
    """``a, b``: links between the documents that stand for their fingerprints
    (``fp``, ``rep``; each fingerprint once), enough to connect all groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for members in batch.column("members").to_pylist():
                    reps = [m["rep"] for m in members]
                    for rep, top in zip(reps, shard_links([m["fp"] & FULL for m in members], radius), strict=True):
                        if reps[top] != rep:
                            yield {"a": rep, "b": reps[top]}

        yield from batched(rows(), _LINKS)

    return shards(fps, radius, most).select("members").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, most: int = 1024,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id``: one row per input row; the component is
    the smallest ``doc_id`` that its chain of links reaches."""
    found = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-fps")
    classes = materialize(found.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    comps = components(links(classes.filter("rep IS NOT NULL"), radius, most)).withColumnsRenamed({"node": "rep"})
    merged = classes.join(comps, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return found.join(merged, "fp").select("doc_id", "fp", "component_id")
