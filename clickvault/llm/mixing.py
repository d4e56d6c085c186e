"""Mixing sources to target weights by Pareto order sampling.

Targets. Sources, ordered by code point (null last), weigh ``weights`` in
turn; they share ``share`` times all words by weight, but none gets more than
``most`` times its own: what is above is shared again by weight until no
source is above. That is one level for all, ``min(most * size, level *
weight)``, found over the sources sorted by ``size / weight``.

Expected copies. Within a source a document of ``x`` words is expected
``min(most, k * x ** power)`` times, ``k`` such that the expected words are
the target: the longer a document, the surer its copies, so the words taken
vary little although lengths do a lot. Whole copies are taken for certain
(the integer part); the fraction is the document's inclusion probability.

Pareto order sampling. A document of inclusion probability ``p`` and uniform
``u`` (hash of id and text) ranks by ``(u / (1 - u)) / (p / (1 - p))``. Each
source takes the documents of smallest rank until the words reach what the
certain copies left of its target; the last one only where that comes nearer.
So a source misses its target by at most half the length of one document.

At scale nothing is sorted: ranks are mapped to (0, 1) and counted in
``BINS`` bins a source, then the bin in which the target is met is counted in
``BINS`` finer ones, ``LEVELS`` times, and only documents of that last one
(about ``BINS ** -LEVELS`` of a source) are put in order. Texts are read once; all else works on a few
numbers a document. One row a source is the only table that meets in one task
(the sources' order is global). Built-in functions only.

Defined results: null and blank texts have size 0 and are never taken. Null
sources are one source, the last. Repeated rows (same id, text and source)
are told apart by count alone: those in the last bin are counted, not listed,
and any of them are taken. Ties rank by hash and id. An empty table gives no
rows. Runs agree row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickvault.llm.common import NOT_SPACE, materialize, pick
from clickvault.plans.materialize import small_side

BINS, LEVELS = 1 << 8, 3
RUN = 1 << 16  # repeated rows made by one task at a time
_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)
_BEFORE = (Window.unboundedPreceding, -1)


def n_words(text: Column) -> Column:
    """How many runs of anything but white space (null: 0)."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), NOT_SPACE, -1), "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source source_size weight target`` from one row (``source source_size``) a source."""
    in_turn = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    rows = sizes.withColumn("weight", F.get(in_turn, (F.row_number().over(by_name) - 1) % len(weights)))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    every = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(*_ALL)
    stopped = F.coalesce(F.sum(F.col("source_size")).over(by_ratio.rowsBetween(*_BEFORE)), F.lit(0)) * F.lit(float(most))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_ratio.rowsBetween(*_BEFORE)), F.lit(0.0))
    rows = rows.withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share)) - stopped) / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("source_size") * F.lit(float(most)), F.col("level"))
    level = F.coalesce(F.first(fits, ignorenulls=True).over(every), F.lit(float("inf")))
    return rows.select("source", "source_size", "weight",
                       F.least(F.col("source_size") * F.lit(float(most)), level * F.col("weight")).alias("target"))


def _factors(sized: DataFrame, goal: DataFrame, most: float, power: float) -> DataFrame:
    """``source factor``: ``k`` of each source that has words (null: all its documents are taken ``most`` times).

    Works on one row per source and length: with the lengths from some one up
    at ``most`` copies, ``k`` is what is left over the weights of the rest;
    the longest length that this ``k`` does not bring above ``most`` decides.
    """
    x = sized.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    x = x.join(goal.select(F.col("source").alias("of"), "target", "source_size"), F.col("source").eqNullSafe(F.col("of")))
    w = F.pow(F.col("size").cast("double"), F.lit(power))
    up_to = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    longer = F.col("source_size") - F.sum(F.col("n") * F.col("size")).over(up_to)
    k = (F.col("target") - longer * F.lit(float(most))) / F.sum(F.col("n") * F.col("size") * w).over(up_to)
    x = x.select("source", "size", k.alias("k"), w.alias("w"))
    return x.groupBy("source").agg(F.max_by("k", F.when(F.col("k") * F.col("w") <= F.lit(float(most)), F.col("size"))).alias("factor"))


def _bin(z: Column, level: int) -> Column:
    """The bin of ``z`` among ``BINS ** level``, within that of the level above."""
    at = F.floor(z * F.lit(float(BINS ** level)))
    return F.least(at, F.lit(BINS ** level - 1)) % BINS


def _met(counted: DataFrame, bin_col: str) -> DataFrame:
    """Each source's bin in which the words (with those of ``start``) reach ``room``, and the words before it."""
    order = Window.partitionBy("source").orderBy(bin_col)
    at = F.col("start") + F.coalesce(F.sum("words").over(order.rowsBetween(*_BEFORE)), F.lit(0))
    reached = counted.withColumn("at", at).filter(F.col("at") + F.col("words") >= F.col("room"))
    return reached.groupBy("source").agg(F.min_by(F.struct(bin_col, "at"), bin_col).alias("met"))


def _with(rows: DataFrame, side: DataFrame, name: str, how: str = "inner") -> DataFrame:
    """Join one row a source to the rows: broadcast by measured size, else a shuffle join."""
    held, _ = small_side(side.withColumnRenamed("source", "_of"), name)
    return rows.join(held, F.col("source").eqNullSafe(F.col("_of")), how).drop("_of")


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, power: float = 0.5,
        seed: int = 13, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id source size source_size target copies certain probability
    taken``, a row per document: ``copies`` whole copies are taken, ``taken``
    words in all."""
    docs = pick(docs, id_col, text_col, source_col).toDF("doc_id", "text", "source")
    h = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), h.alias("h")), "mix-sizes")
    goal = materialize(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")

    goals = goal.join(_factors(sized, goal, most, power).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
    rows = _with(sized, goals.select("source", "source_size", "target", "factor"), "mix-factors")
    copies = F.coalesce(F.least(F.lit(float(most)), F.col("factor") * F.pow(F.col("size").cast("double"), F.lit(power))), F.lit(float(most)))
    rows = rows.withColumn("expected", F.when(F.col("size") > 0, copies).otherwise(0.0))
    rows = rows.withColumn("certain", F.floor("expected")).withColumn("p", F.col("expected") - F.col("certain"))
    u = (F.pmod(F.col("h"), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    against, for_ = u * (1 - F.col("p")), (1 - u) * F.col("p")  # their quotient is the Pareto rank
    rows = rows.withColumn("z", F.when(F.col("p") > 0, against / (against + for_))).drop("expected", "factor")
    for level in range(1, LEVELS + 1):
        rows = rows.withColumn(f"b{level}", _bin(F.col("z"), level))
    ranked = materialize(rows, "mix-ranked")

    cut = ranked.groupBy("source").agg(F.sum(F.col("certain") * F.col("size")).alias("sure"), F.first("target").alias("target"))
    cut = cut.select("source", (F.col("target") - F.col("sure")).alias("room"), F.lit(0).cast("long").alias("start"))
    drawn, inside = ranked.filter("z IS NOT NULL"), F.lit(True)
    for level in range(1, LEVELS + 1):
        inner = _with(drawn, cut, f"mix-cut{level}").filter(inside)
        met = _met(inner.groupBy("source", "room", "start", f"b{level}").agg(F.sum("size").alias("words")), f"b{level}")
        met = met.select("source", F.col(f"met.b{level}").alias(f"m{level}"), F.col("met.at").alias("at"))
        cut = materialize(_with(cut, met, f"mix-met{level}", "left").withColumn("start", F.col("at")).drop("at"), "mix-cuts")
        inside = inside & (F.col(f"b{level}") == F.col(f"m{level}"))

    out = ["doc_id", "source", "size", "source_size", "target", "certain", "p"]
    rows = _with(ranked, cut, "mix-cut", "left").withColumn("last", F.coalesce(F.col("z").isNotNull() & inside, F.lit(False)))
    bins, met = (F.array(*[F.col(f"{c}{i}") for i in range(1, LEVELS + 1)]) for c in "bm")
    under = F.col("m1").isNull() | (bins < met)
    plain = rows.filter(~F.col("last")).select(*out, F.when(F.col("z").isNotNull() & under, 1).otherwise(0).alias("drawn"))

    # the last bin: equal rows counted, then put in order; the one at the border only if that comes nearer
    units = rows.filter("last").groupBy(*out, "z", "h", "start", "room").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("source").orderBy("z", "h", F.asc_nulls_first("doc_id"), "size").rowsBetween(*_BEFORE)
    start = F.col("start") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(order), F.lit(0))
    units = units.withColumn("fit", F.floor((F.col("room") - start) / F.col("size") + 0.5))
    runs = units.withColumn("at", F.explode(F.expr(f"sequence(0L, n - 1, {RUN}L)"))).repartition("h", "at")
    each = runs.withColumn("i", F.explode(F.expr(f"sequence(at, least(at + {RUN - 1}, n - 1))")))
    each = each.select(*out, F.when(F.col("i") < F.col("fit"), 1).otherwise(0).alias("drawn"))
    copies = (F.col("certain") + F.col("drawn")).cast("long")
    return plain.unionByName(each).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), "certain",
                                          F.col("p").alias("probability"), (copies * F.col("size")).alias("taken"))
