"""Benchmark decontamination by winnowing.

Of every ``WINDOW - K + 1`` consecutive ``K``-word hashes the first smallest is kept
as a fingerprint, on both sides by the same rule. A span
of ``WINDOW`` words that an item and a document share holds that many hashes,
so it keeps the same smallest on both sides: no shared span is missed.
Fingerprints are joined and every hit is extended word by word in both
directions; runs of at least ``WINDOW`` words are leaks.

Extending a hit by at most ``WINDOW - K`` words to each side is enough: every
shared window holds a hit, and all windows that hold it lie in that reach. So
a hit carries a few words, never a text.

Items shorter than the window are one window; each of their (at most
``WINDOW - 1``) lengths is looked up whole.

Native: words and hashes stay arrays of the document's row, positions are
exploded inside one generated loop, and only hits and one row a document
leave the scan; texts are never shuffled. The items are cut into blocks of
at most ``BLOCK`` fingerprints, and each block is broadcast on its own, so
the broadcast is bounded however large the benchmark is.

Null text has no words, an item without words no window. Repeated rows are
rows of their own; items with the same id are one item, those without one are
the item "null". Empty tables give no
rows, or no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickvault.llm.common import materialize, pick, with_words

WINDOW, K = 10, 5
BLOCK = 200_000


def gram_hash(words: str, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(n)])


def hashes(words: str) -> Column:
    """The hashes of all ``K``-word grams of an array of words."""
    return F.when(F.size(words) >= K, F.transform(F.sequence(F.lit(0), F.size(words) - K), lambda i: gram_hash(words, i, K)))


def smallest(h: str, start: Column, n: int) -> Column:
    """The smallest of ``n`` hashes from ``start`` on."""
    return F.least(*[F.get(h, start + i) for i in range(n)])


def fingerprints(words: DataFrame, own_row: bool = False) -> DataFrame:
    """``words`` (array ``w`` and other columns) exploded at the windows that bring
    a fingerprint: ``s`` (the window's first hash) and ``hash``, its smallest; with
    ``own_row`` also once at -1 with hash 0. The hashes stay in ``h``.

    A window repeats the fingerprint of the window before it unless that one's
    first hash was among the smallest or its own last hash is smaller than all
    before; only then it is kept. So every window's first smallest hash is kept
    once, whatever repeats.
    """
    span = WINDOW - K  # a window has span + 1 hashes
    h = words.withColumn("h", F.when(F.size("w") >= WINDOW, hashes("w")).otherwise(F.array().cast("array<bigint>")))
    # outer: a filter inferred from the generator would compute the hashes twice
    last = F.greatest(F.size("h") - span - 1, F.lit(-1))
    at = h.select("*", F.explode_outer(F.sequence(F.lit(-1), last)).alias("s"))
    inner = smallest("h", F.col("s"), span)
    fresh = (F.col("s") == 0) | (F.get("h", F.col("s") - 1) <= inner) | (F.get("h", F.col("s") + span) < inner)
    at = at.filter((F.col("s") >= 0) & fresh | (F.col("s") < 0) & F.lit(own_row))
    return at.withColumn("hash", F.when(F.col("s") >= 0, smallest("h", F.col("s"), span + 1)).otherwise(F.lit(0)))


def first_place(found: DataFrame) -> DataFrame:
    """Adds ``at``, the first position of a window's smallest hash."""
    same = F.filter(F.sequence(F.lit(0), F.lit(WINDOW - K)), lambda i: F.get("h", F.col("s") + i) == F.col("hash"))
    return found.withColumn("at", F.col("s") + F.get(same, F.lit(0)))


def around(words: str, at: Column, by: int) -> list[Column]:
    """The words at ``by`` steps before or after a gram; null beyond the text."""
    return F.get(words, at + by)


def equal_run(left: list[Column], right: list[Column], other_left: list[Column], other_right: list[Column]) -> tuple[Column, Column]:
    """How many words in a row agree to the left and to the right."""
    out = []
    for mine, theirs in ((left, other_left), (right, other_right)):
        ok, total = None, F.lit(0)
        for a, b in zip(mine, theirs, strict=True):
            here = F.coalesce(a == b, F.lit(False))
            ok = here if ok is None else ok & here
            total = total + ok.cast("int")
        out.append(total)
    return out[0], out[1]


def _blocks(side: DataFrame) -> list[DataFrame]:
    n = -(-side.count() // BLOCK) or 1
    return [side] if n == 1 else [side.filter(F.pmod("hash", F.lit(n)) == b) for b in range(n)]


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``rid doc_id n_words item lo hi``: the runs ``[lo, hi)`` of a document's
    words that stand in an item, and one row a document whose ``item`` is null."""
    span = WINDOW - K
    rows = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn("rid", F.monotonically_increasing_id())
    words = with_words(rows, "text", "w").withColumn("n_words", F.size("w"))
    given = pick(items, item_col, item_text_col).toDF("item", "text").withColumn("item", F.coalesce(F.col("item").cast("string"), F.lit("null")))
    item_words = materialize(with_words(given, "text", "w").filter(F.size("w") > 0), "leak-items")
    steps = range(1, span + 1)
    item_fp = materialize(first_place(fingerprints(item_words)).select(
        "hash", "item", F.array(*[F.get("w", F.col("at") + i) for i in range(K)]).alias("gram"),
        F.array(*[around("w", F.col("at"), -i) for i in steps]).alias("before"),
        F.array(*[around("w", F.col("at"), K - 1 + i) for i in steps]).alias("after")).distinct(), "leak-fingerprints")
    short = item_words.filter(F.size("w") < WINDOW).select("item", "w", F.size("w").alias("n")).distinct()
    lengths = [r["n"] for r in short.select("n").distinct().collect()]  # at most WINDOW - 1
    blocks = _blocks(item_fp)
    if len(blocks) + len(lengths) > 1:  # several passes must find a row under the same number
        words = materialize(words, "leak-words")
    hits = []
    for i, b in enumerate(blocks):
        # at -1 a document meets one row of its own, so its row comes out of the same pass
        # (made by the JVM: rows given as Python objects start workers of their own, which stay)
        own = docs.sparkSession.range(0, 1, 1, 1).select(*[F.lit(0 if c.name == b.columns[0] else None).cast(c.dataType).alias(c.name) for c in b.schema])
        hit = fingerprints(words, own_row=i == 0).join(F.broadcast(b.unionByName(own) if i == 0 else b), "hash")
        # a hit takes the words around its window with it; all else is worked out on hits alone,
        # so the loop over all positions stays small enough to be compiled
        hit = hit.filter((F.col("s") >= 0) == F.col("item").isNotNull()).withColumn("base", F.greatest(F.col("s") - span, F.lit(0)))
        hits.append(hit.select("rid", "doc_id", F.col("n_words").cast("long").alias("n_words"), "item", "s", "base",
                               F.slice("w", F.col("base") + 1, F.lit(3 * span + K)).alias("near"), "gram", "before", "after"))
    hits = materialize(reduce(DataFrame.unionByName, hits), "leak-hits")
    places = F.filter(F.sequence(F.col("s") - F.col("base"), F.col("s") - F.col("base") + span), lambda i: F.slice("near", i + 1, F.lit(K)) == F.col("gram"))
    hits = hits.withColumn("i", F.when(F.col("item").isNotNull(), F.get(places, F.lit(0)))).filter("item IS NULL OR i IS NOT NULL")
    i, at = F.col("i"), F.col("base") + F.col("i")
    left, right = equal_run([around("near", i, -j) for j in steps], [around("near", i, K - 1 + j) for j in steps],
                            [F.get("before", F.lit(j - 1)) for j in steps], [F.get("after", F.lit(j - 1)) for j in steps])
    run = hits.select("rid", "doc_id", "n_words", "item", F.when(i.isNotNull(), at - left).alias("lo"), F.when(i.isNotNull(), at + K + right).alias("hi"))
    found = [run.filter(F.col("item").isNull() | (F.col("hi") - F.col("lo") >= WINDOW))]
    at = F.col("at")
    for n in lengths:
        for b in _blocks(materialize(short.filter(F.col("n") == n).select(gram_hash("w", F.lit(0), n).alias("hash"), "item", F.col("w").alias("gram")), "leak-short")):
            spot = words.filter(F.col("n_words") >= n).select("*", F.explode_outer(F.sequence(F.lit(0), F.col("n_words") - n)).alias("at"))
            hit = spot.withColumn("hash", gram_hash("w", at, n)).join(F.broadcast(b), "hash")
            hit = hit.filter(F.slice("w", at + 1, F.lit(n)) == F.col("gram"))
            found.append(hit.select("rid", "doc_id", F.col("n_words").cast("long").alias("n_words"), "item", at.alias("lo"), (at + n).alias("hi")))
    return reduce(DataFrame.unionByName, found)


def decontaminate(docs: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """Per document: ``doc_id n_words n_hit n_items items spans contaminated``;
    ``items`` sorted as strings, ``spans`` the joined runs as first word and word after the last."""
    rows = materialize(find(docs, items, **columns), "leak-runs")
    runs = rows.filter("item IS NOT NULL")
    items_of = runs.groupBy("rid", "item").agg(F.lit(1).alias("one")).groupBy("rid").agg(F.sort_array(F.collect_list("item")).alias("items"))
    ranges = runs.groupBy("rid", "lo").agg(F.max("hi").alias("hi"))
    order = Window.partitionBy("rid").orderBy("lo")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    joined = (ranges.withColumn("reach", reach).withColumn("new", F.coalesce(F.col("lo") > F.col("reach"), F.lit(True)).cast("int"))
              .withColumn("part", F.sum("new").over(order)).groupBy("rid", "part").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    spans = joined.groupBy("rid").agg(F.sum(F.col("hi") - F.col("lo")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
    out = rows.filter("item IS NULL").select("rid", "doc_id", "n_words").join(spans, "rid", "left").join(items_of, "rid", "left")
    items_list = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items_list).cast("long").alias("n_items"),
                      items_list.alias("items"), "spans", (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def oracle_sql() -> str:
    """The same in DuckDB's SQL: every window's words as text, no fingerprints."""
    words = lambda c: (f"list_filter(string_split_regex(translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "  # noqa: E731
                       r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    ahead = ", ".join(f"lead(word, {i}) OVER o" for i in range(WINDOW))
    grams = lambda t, key: f"""SELECT {key}, n, pos, m, array_to_string(ws[1:n], ' ') AS gram FROM (  # noqa: E731
    SELECT *, [{ahead}] AS ws FROM (SELECT {key}, len(w) AS m, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM {t})
    WINDOW o AS (PARTITION BY {key} ORDER BY pos)), """.replace("  # noqa: E731", "")
    return f"""
WITH b AS (SELECT row_number() OVER () AS r, item_id::VARCHAR AS item, {words('text')} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, gram FROM ({grams('b', 'r')} (SELECT unnest(range(1, {WINDOW + 1})) AS n)
       WHERE n = least(m, {WINDOW}) AND pos <= m - n) JOIN b USING (r)),
d AS (SELECT doc_id, {words('text')} AS w FROM documents),
dg AS ({grams('d', 'doc_id')} (SELECT DISTINCT n FROM bw) WHERE pos <= m - n),
hit AS (SELECT DISTINCT doc_id, item, n, pos FROM dg JOIN bw USING (n, gram)),
counted AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
"""
