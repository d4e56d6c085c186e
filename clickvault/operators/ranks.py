"""Exact quantiles by distributed rank selection.

``percentile`` merges one count per distinct value of the whole table in one
task. Here the counts per distinct value are range-partitioned by value and
written; each partition keeps its own running counts, one total per partition
gives where it starts, and only the values at the two ranks around each
quantile are picked. No task sees more than a partition's distinct values
(plus one row per partition), whatever the number of rows or values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickvault.plans.materialize import materialize


def running_counts(df: DataFrame, value: str) -> DataFrame:
    """``value n first``: each distinct non-null value, its rows, and the
    rank (from 0) of its first row among all rows in value order."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # written once: range bounds come from a sample, so both uses below must see the same partitions
    ranged = materialize(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "value-counts")
    starts = (ranged.groupBy("part").agg(F.sum("n").alias("rows"), F.min("value").alias("low"))
              .select("part", F.coalesce(F.sum("rows").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)),
                                         F.lit(0)).alias("start")))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (ranged.withColumn("inside", inside).join(starts, "part")
            .select("value", "n", (F.col("start") + F.col("inside")).alias("first")))


def exact_quantiles(df: DataFrame, value: str, probs: tuple[float, ...]) -> DataFrame:
    """One row ``rows, quantiles``: linear interpolation between the ranks
    around ``p * (rows - 1)``, one entry per ``p`` (null when there is no row)."""
    counts = running_counts(df, value)
    rows = counts.agg(F.max(F.col("first") + F.col("n")).alias("rows")).scalar()
    at = [F.lit(float(p)) * (rows - 1) for p in probs]
    picks = []
    for i, place in enumerate(at):
        for edge, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("first") <= rank) & (rank < F.col("first") + F.col("n"))
            picks.append(F.max(F.when(here, F.col("value"))).cast("double").alias(f"{edge}{i}"))
    found = counts.agg(F.coalesce(F.max(F.col("first") + F.col("n")), F.lit(0)).alias("rows"), *picks)

    def between(i: int):
        place = F.lit(float(probs[i])) * (F.col("rows") - 1)
        share = place - F.floor(place)
        return F.col(f"lo{i}") * (1 - share) + F.col(f"hi{i}") * share

    return found.select("rows", F.array(*[between(i) for i in range(len(probs))]).alias("quantiles"))


def rank_error(df: DataFrame, value: str, threshold, p: float, rows):
    """How far ``p`` lies outside the share of rows below and up to the
    threshold: 0 when the threshold is a true ``p`` quantile."""
    below = F.count_if(F.col(value) < threshold) / rows
    up_to = F.count_if(F.col(value) <= threshold) / rows
    return F.greatest(F.lit(0.0), below - F.lit(p), F.lit(p) - up_to)
