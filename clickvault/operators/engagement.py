"""Customer engagement: per-user counts, score and Low/Medium/High level.

Score = views + 3 * carts + 5 * purchases. Levels split at the 33rd and 67th
percentile of all users' scores: Low <= q33 < Medium <= q67 < High. With
fewer than 3 users every user is Medium and both thresholds are the median
(0.0 when there is no user).

The thresholds are one row computed from the per-user table and used as a
scalar subquery: no driver round trip in the plan, no join; Spark reuses the
per-user shuffle for the subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickvault.operators.category import purchase_sum, type_count
from clickvault.operators.ranks import exact_quantiles, rank_error

QUANTILES = (0.33, 0.67)
# Fixed score weights: views x1, carts x3, purchases x5 (remove_from_cart x0).
WEIGHTS = {"views": 1, "carts": 3, "purchases": 5}
APPROX_ACCURACY = 1000  # relative error 1/1000, as approxQuantile(..., 0.001)
METHODS = ("exact", "approx")


def user_activity(silver: DataFrame) -> DataFrame:
    """Per user: four event counts, distinct sessions, purchase value, totals, score.

    ``countDistinct`` with a grouping key plans as a two-level aggregate
    (user, session) then user, both combined map-side.
    """
    base = silver.groupBy("user_id").agg(
        type_count("view", "views"), type_count("cart", "carts"),
        type_count("purchase", "purchases"), type_count("remove_from_cart", "remove_from_cart"),
        F.expr("count(DISTINCT user_session) AS sessions"),
        purchase_sum().alias("purchase_value"),
    )
    score = " + ".join(f"{c} * {w}" for c, w in WEIGHTS.items())
    return base.selectExpr(
        "*",
        "views + carts + purchases + remove_from_cart AS total_interactions",
        f"CAST({score} AS BIGINT) AS engagement_score",
    )


def engagement_thresholds(users: DataFrame, method: str = "exact") -> DataFrame:
    """One row: ``users``, ``q33``, ``q67`` with the small-population rule.

    ``exact``: linear interpolation between ranks (pandas/`quantile_cont`),
    the ranks selected over range-partitioned score counts (``ranks.py``; the
    counts are written when this is called).
    ``approx``: Greenwald-Khanna sketch (``percentile_approx``), lazy.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    s = F.col("engagement_score")
    if method == "exact":
        agg = exact_quantiles(users, "engagement_score", (*QUANTILES, 0.5)).toDF("users", "_qs")
        median = F.col("_qs")[2]
    else:  # fewer than three users: their median is the mean of the smallest and the largest
        qs = F.percentile_approx(s, F.array(*[F.lit(q) for q in QUANTILES]), APPROX_ACCURACY).cast("array<double>")
        median = (F.col("_min") + F.col("_max")) / 2
        agg = users.agg(F.count(F.lit(1)).alias("users"), qs.alias("_qs"), F.min(s).alias("_min"), F.max(s).alias("_max"))
    small = F.col("users") < 3
    fallback = F.coalesce(median.cast("double"), F.lit(0.0))
    return agg.select(
        "users",
        F.when(small, fallback).otherwise(F.col("_qs")[0]).alias("q33"),
        F.when(small, fallback).otherwise(F.col("_qs")[1]).alias("q67"),
    )


def approx_threshold_errors(users: DataFrame) -> DataFrame:
    """``quantile, rank_error, within`` of each approximate threshold: how far
    its true rank share lies from the quantile, and whether that is within the
    sketch's promise of ``1 / APPROX_ACCURACY``."""
    thr = engagement_thresholds(users, "approx").select(F.struct("users", "q33", "q67")).scalar()
    errors = users.agg(F.count(F.lit(1)).alias("n"), *[
        rank_error(users, "engagement_score", thr[c], q, F.count(F.lit(1))).alias(c) for q, c in zip(QUANTILES, ("q33", "q67"), strict=True)])
    rows = errors.select(F.inline(F.array(*[F.struct(F.lit(q).alias("quantile"), F.coalesce(F.col(c), F.lit(0.0)).alias("rank_error"))
                                            for q, c in zip(QUANTILES, ("q33", "q67"), strict=True)])))
    return rows.withColumn("within", F.col("rank_error") <= F.lit(1.0 / APPROX_ACCURACY))


def level_expr(score: Column, thresholds: Column) -> Column:
    """``thresholds`` is a struct(users, q33, q67) column."""
    return (
        F.when(thresholds["users"] < 3, F.lit("Medium"))
        .when(score <= thresholds["q33"], F.lit("Low"))
        .when(score <= thresholds["q67"], F.lit("Medium"))
        .otherwise(F.lit("High"))
    )


def customer_engagement(silver: DataFrame, method: str = "exact") -> DataFrame:
    """Gold table 1."""
    users = user_activity(silver)
    thr = engagement_thresholds(users, method).select(F.struct("users", "q33", "q67")).scalar()
    return users.select("*", level_expr(F.col("engagement_score"), thr).alias("engagement_level"))


def join_fill_zero(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join of per-key aggregates; keys absent on the right get 0.

    (The Gold tables avoid it with one conditional aggregate; kept as the
    general form for separately computed per-key tables.)"""
    fill = {c: 0 for c in right.columns if c != key}
    return left.join(right, key, "left").fillna(fill)
