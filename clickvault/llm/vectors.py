"""Vector codes: product quantization with equal-average nearest-entry search.

A vector's components become integers, ``floor(scale * x)``, and it is cut
into equal consecutive parts. Every part position has a codebook: it starts as
that part of the vectors of smallest id, and each round replaces an entry by
the componentwise floor of the mean of the parts nearest to it.

Search. Entries are sorted by the sum of their components. For a part of sum
``s`` and ``d`` components an entry of sum ``t`` is at least ``(s - t)^2 / d``
away, so the search starts at ``s`` and goes outward in both directions until
that bound strictly exceeds the best distance (an equal one may still hide a
tie of lower index). Parts of a batch are sorted by sum too and searched in
chunks, which share their start and leave the search one by one.

All arithmetic is exact: 64-bit floats only while every sum stays an integer
below 2^53, 64-bit integers beyond.

At scale: a round is one pass over the vectors; a task sends one row per used
entry (sums and count), at most ``parts * entries`` rows whatever it read.
Codebooks (``parts * entries`` short vectors, a parameter's size) are all that
meets the driver or is sent to the tasks. The seeds are picked in a tree, so
no task reads a row of every other one.

Defined results: null vectors and those with null or non-finite components are
dropped. Vectors that have no ``parts`` equal parts, whose length is not the
table's most frequent one (ties: the longer), or with a component so large
that distances would leave 64 bits (``limit``), stay with null code and
errors and take no part in anything. Equal ids are ordered by their vectors,
null ids come last; repeated rows count each. Fewer vectors than entries give
a smaller codebook; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import materialize, pick
from clickvault.plans.materialize import small_side

CHUNK = 256  # parts that search together
BLOCK = 16  # entries looked at in one step
FAN_IN = 64  # tasks of the middle level of the seeds' tree


def limit(width: int) -> int:
    """Components up to this size keep the summed squared distances of a whole vector within 64 bits."""
    return math.isqrt((1 << 62) // (4 * max(width, 1)))


def integers(col: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(kept, usable, values)``: rows that stay, rows that can be coded, and
    the integer components (rows, width) of the latter."""
    n = len(col)
    lengths = np.asarray(pc.fill_null(pc.list_value_length(col), 0)).astype(np.int64)
    flat = pc.cast(col.flatten(), pa.float64())
    bad = np.asarray(pc.fill_null(pc.invert(pc.is_finite(flat)), True)).astype(bool)
    x = np.floor(np.asarray(pc.fill_null(flat, 0.0), dtype=np.float64) * scale)
    ends = np.cumsum(lengths)
    broken = np.concatenate([[0], np.cumsum(bad)])
    kept = np.asarray(pc.is_valid(col)).astype(bool) & (broken[ends] == broken[ends - lengths])
    fits = kept & (lengths == width)
    rows = np.flatnonzero(fits)
    if not width or not len(rows):
        return kept, np.zeros(n, bool), np.zeros((0, width), np.int64)
    x = x[(ends - lengths)[rows][:, None] + np.arange(width)]
    small = (np.abs(x) <= limit(width)).all(axis=1)
    usable = np.zeros(n, bool)
    usable[rows[small]] = True
    return kept, usable, x[small].astype(np.int64)


class EqualAverage:
    """One codebook, sorted by component sum."""

    def __init__(self, book: np.ndarray):
        self.dim = book.shape[1]
        sums = book.sum(axis=1)
        order = np.lexsort((np.arange(len(book)), sums))
        self.book, self.sums, self.index = book[order], sums[order], order
        self.reach = int(np.abs(book).max(initial=0))

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each part's nearest entry, ties to the lower index."""
        top = max(self.reach, int(np.abs(parts).max(initial=0)))
        kind = np.float64 if 4 * top * top * self.dim < 1 << 53 else np.int64
        book = self.book.astype(kind)
        own = (book * book).sum(axis=1)
        sums = parts.sum(axis=1)
        by_sum = np.argsort(sums, kind="stable")
        found, far = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for at in range(0, len(parts), CHUNK):
            rows = by_sum[at:at + CHUNK]
            found[rows], far[rows] = self._chunk(parts[rows].astype(kind), sums[rows], book, own)
        return found, far

    def _chunk(self, parts, sums, book, own):
        n = len(parts)
        norms = (parts * parts).sum(axis=1)
        best = np.full(n, np.iinfo(np.int64).max)
        index = np.full(n, len(book))

        def look(rows, lo, hi):
            """Compare some rows with the entries lo..hi."""
            order = np.argsort(self.index[lo:hi])  # argmin then takes the lowest index of equal distances
            cols = np.arange(lo, hi)[order]
            gap = norms[rows][:, None] - 2 * (parts[rows] @ book[cols].T) + own[cols]
            least = gap.argmin(axis=1)
            d, j = gap[np.arange(len(rows)), least].astype(np.int64), self.index[cols[least]]
            better = (d < best[rows]) | ((d == best[rows]) & (j < index[rows]))
            best[rows[better]], index[rows[better]] = d[better], j[better]

        def open_(rows, entry, above):
            """The rows that entry (the next one outward) can still help."""
            gap = self.sums[entry] - sums[rows] if above else sums[rows] - self.sums[entry]
            # squares up to 2^62 are exact in integers; the quotient's ceiling keeps the bound exact
            gap = np.maximum(gap, 0)
            gap = np.where(gap > 3_000_000_000, 0, gap)  # a square beyond 64 bits: no bound, look at all
            bound = -((-gap ** 2) // self.dim)
            return rows[bound <= best[rows]]

        lo = hi = int(np.searchsorted(self.sums, sums[n // 2]))
        down = up = np.arange(n)
        while len(down) or len(up):
            if hi < len(book) and len(up):
                up = open_(up, hi, True)
                end = min(hi + BLOCK, len(book))
                if len(up):
                    look(up, hi, end)
                hi = end
            else:
                up = up[:0]
            if lo > 0 and len(down):
                down = open_(down, lo - 1, False)
                end = max(lo - BLOCK, 0)
                if len(down):
                    look(down, end, lo)
                lo = end
            else:
                down = down[:0]
        return index, best


def _lowest(n: int, width: int, scale: int, vec_col: str, id_col: str):
    """Task function: the task's ``n`` vectors of smallest id, as integers."""
    schema = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            _, usable, x = integers(batch.column(batch.schema.get_field_index(vec_col)), width, scale)
            ids = batch.column(batch.schema.get_field_index(id_col)).filter(pa.array(usable))
            rank = np.asarray(pc.fill_null(ids, 0))
            null = np.asarray(pc.is_null(ids)).astype(bool)
            rows = np.lexsort((*x.T[::-1], rank, null))[:n] if len(x) else []
            held = heapq.nsmallest(n, held + [(bool(null[r]), int(rank[r]), *x[r].tolist()) for r in rows])
        if held:
            yield pa.RecordBatch.from_pylist([{"id": None if h[0] else h[1], "v": list(h[2:])} for h in held], schema)

    return run


def _width(rows: DataFrame, vec_col: str, parts: int) -> int:
    """The most frequent length that has ``parts`` equal parts."""
    lengths = (rows.groupBy(F.size(vec_col).alias("n")).count().filter(F.col("n") > 0).filter(F.col("n") % parts == 0)
               .orderBy(F.desc("count"), F.desc("n")).limit(1).collect())
    return lengths[0]["n"] if lengths else 0


def books_text(books: list[np.ndarray]) -> str:
    """The components by part, entry and position, comma-joined."""
    return ",".join(str(v) for book in books for v in book.ravel().tolist())


def fit_books(rows: DataFrame, width: int, id_col: str, vec_col: str, parts: int, entries: int, rounds: int,
              scale: int) -> list[np.ndarray]:
    """The codebook (entries, width / parts) of every part position."""
    kind = "id long, v array<long>"
    lowest = rows.mapInArrow(_lowest(entries, width, scale, vec_col, id_col), kind)
    middle = lowest.repartition(FAN_IN).mapInArrow(_lowest(entries, width, 1, "v", "id"), kind)
    seeds = middle.orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    first = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), width)
    books = np.split(first, parts, axis=1) if width else [first] * parts
    for _ in range(rounds if len(seeds) else 0):
        sums = (rows.select(vec_col).mapInArrow(_sums(books, width, scale, vec_col), "part int, entry int, n long, total array<long>")
                .select("part", "entry", "n", F.posexplode("total").alias("pos", "x"))
                .groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("x").alias("x")))
        books = [b.copy() for b in books]
        for r in sums.collect():  # at most one row per component of the codebooks
            books[r["part"]][r["entry"], r["pos"]] = r["x"] // r["n"]
    return books


def _sums(books: list[np.ndarray], width: int, scale: int, vec_col: str):
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [EqualAverage(b) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            _, _, x = integers(batch.column(batch.schema.get_field_index(vec_col)), width, scale)
            for p, part in enumerate(np.split(x, len(books), axis=1)):
                near, _ = search[p].nearest(part)
                counts[p] += np.bincount(near, minlength=len(counts[p]))
                np.add.at(totals[p], near, part)
        out = [{"part": p, "entry": int(e), "n": int(counts[p][e]), "total": totals[p][e].tolist()}
               for p in range(len(books)) for e in np.flatnonzero(counts[p])]
        yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _codes(books: list[np.ndarray], width: int, scale: int, id_col: str, vec_col: str, label_col: str, label_type: pa.DataType):
    schema = pa.schema([("vec_id", pa.int64()), ("label", label_type), ("code", pa.string()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [EqualAverage(b) for b in books]
        for batch in batches:
            ids, vecs, labels = (batch.column(batch.schema.get_field_index(c)) for c in (id_col, vec_col, label_col))
            kept, usable, x = integers(vecs, width, scale)
            code = np.zeros((len(x), len(books)), np.uint8 if max(map(len, books), default=0) <= 256 else np.dtype(">u2"))
            error = np.zeros(len(x), np.int64)
            for p, part in enumerate(np.split(x, len(books), axis=1)):
                near, far = search[p].nearest(part)
                code[:, p], error = near, error + far
            at = pa.array(np.cumsum(usable) - 1, mask=~usable)
            found = pa.array([c.tobytes().hex() for c in code], pa.string())
            keep = pa.array(kept)
            yield pa.RecordBatch.from_arrays([a.filter(keep) for a in (
                ids.cast(pa.int64()), labels.cast(label_type), found.take(at), pa.array(error).take(at))], schema=schema)

    return run


def encode(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = 4,
           entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """``vec_id label code error label_error codebooks_sha256`` of every kept
    vector: ``code`` has two hex digits a part (four beyond 256 entries),
    ``error`` is the summed squared distance, ``label_error`` its sum over the
    rows of a label (nulls are a label)."""
    from pyspark.sql.pandas.types import to_arrow_type

    rows = pick(df, id_col, vec_col, label_col).filter(F.col(f"`{vec_col}`").isNotNull())
    label_kind = rows.schema[label_col].dataType
    width = _width(rows, vec_col, parts)
    books = fit_books(rows, width, id_col, vec_col, parts, entries, rounds, scale)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    kind = f"vec_id long, label {label_kind.simpleString()}, code string, error long"
    coded = materialize(rows.mapInArrow(_codes(books, width, scale, id_col, vec_col, label_col, to_arrow_type(label_kind)), kind),
                        "vector-codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    sums, _ = small_side(sums, "label-errors")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
            .select("vec_id", "label", "code", "error", F.expr("try_cast(label_error AS long)").alias("label_error"),
                    F.lit(digest).alias("codebooks_sha256")))


def oracle_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The same in DuckDB for tables of usable vectors: every distance computed, no search."""
    def assign(name: str, book: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT rid, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far
  FROM (SELECT x.rid, x.part, b.entry, CAST(sum((x.v - b.v) * (x.v - b.v)) AS BIGINT) AS far
        FROM x JOIN {book} b ON b.part = x.part AND b.pos = x.pos GROUP BY ALL) GROUP BY ALL)"""

    steps = []
    for r in range(rounds):
        steps.append(assign(f"a{r}", f"b{r}"))
        steps.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN (
    SELECT a.part, a.entry, x.pos, CAST((sum(x.v) - (sum(x.v) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
    FROM a{r} a JOIN x ON x.rid = a.rid AND x.part = a.part GROUP BY ALL) m
  ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rid, vec_id, label, embedding AS e, len(embedding) // {parts} AS d
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (
  SELECT rid, (i - 1) // d AS part, (i - 1) % d AS pos, CAST(floor({scale} * CAST(e[i] AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT rid, e, d, unnest(range(1, len(e) + 1)) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT part, rid AS entry, pos, v FROM x WHERE rid < {entries}),
{",".join(steps)},
{assign("last", f"b{rounds}")},
codes AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', l.entry), '' ORDER BY l.part) AS code, CAST(sum(l.far) AS BIGINT) AS error
  FROM kept k JOIN last l ON l.rid = k.rid GROUP BY k.rid, k.vec_id, k.label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
FROM codes
"""
