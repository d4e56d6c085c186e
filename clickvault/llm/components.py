"""Connected components of a link table, by rounds of star contraction.

Each round first points every node's larger neighbours at the smallest node
it knows, then every node at the smallest of its smaller neighbours; after
few rounds (logarithmic in the longest chain) all that is left is one star
per component, whose centre is its smallest node. Minima are combined before
the shuffle, so a node with very many links sends one row a task. Each round
is written to the shared staging folder: lineage stays short and a lost
executor costs one round's work at most. No link reaches the driver, only two
numbers a round that tell whether anything changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.llm.common import materialize


def _stars(links: DataFrame, keep_larger: bool) -> DataFrame:
    """``links`` (u, v): for each u, its neighbours go to the smallest of u and them."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    near = links.join(least, "u")
    if keep_larger:
        return near.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.filter(F.col("m") < F.col("u")).select("u", F.col("m").alias("v"))
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of a link whose component's smallest
    node is another one (the smallest node itself has no row)."""
    now = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "links")
    seen = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, keep_larger=True).filter("u > v").distinct()
        now = materialize(_stars(large, keep_larger=False).filter("u > v").distinct(), "links")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
