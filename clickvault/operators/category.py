"""Category performance and the event counts it shares with other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import safe_rate_sql



def type_count(event_type: str, name: str) -> F.Column:
    """``count_if(event_type = t)``, aliased (one SQL expression)."""
    return F.expr(f"count_if(event_type = '{event_type}') AS {name}")


def type_counts(prefix_map: dict[str, str]) -> list:
    return [type_count(t, name) for t, name in prefix_map.items()]


def purchase_sum() -> F.Column:
    """sum(price) over purchase events, 0.0 when there are none."""
    return F.expr("sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END)")


CATEGORY_COUNTS = {"view": "views", "cart": "cart_additions", "purchase": "purchases",
                   "remove_from_cart": "remove_from_cart_events"}


def category_counts(silver: DataFrame) -> DataFrame:
    """Per category: count of each event type (one pass, map-side combined)."""
    return silver.groupBy("category_code").agg(*type_counts(CATEGORY_COUNTS))


def category_revenue(silver: DataFrame) -> DataFrame:
    """Per category: sum of purchase-event prices."""
    return silver.groupBy("category_code").agg(purchase_sum().alias("purchase_revenue"))


def with_category_rates(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "*",
        f"{safe_rate_sql('cart_additions', 'views')} AS view_to_cart_rate_pct",
        f"{safe_rate_sql('purchases', 'views')} AS purchase_conversion_rate_pct",
    )


def category_performance(silver: DataFrame) -> DataFrame:
    """Gold table 4: counts, revenue and two rates per category, one aggregate.

    A category key has few values, so a hot category is absorbed by the
    partial (map-side) aggregate: each task ships one row per category.
    """
    agg = silver.groupBy("category_code").agg(
        *type_counts(CATEGORY_COUNTS), purchase_sum().alias("purchase_revenue"))
    return with_category_rates(agg)


def category_performance_from_pairs(pairs: DataFrame) -> DataFrame:
    """Same table re-aggregated from the session x category pairs
    (see ``abandonment.session_category_flags``), to reuse one scan in a job."""
    agg = pairs.groupBy("category_code").agg(
        F.sum("views").alias("views"),
        F.sum("carts").alias("cart_additions"),
        F.sum("purchases").alias("purchases"),
        F.sum("removes").alias("remove_from_cart_events"),
        F.sum("revenue").alias("purchase_revenue"),
    )
    return with_category_rates(agg)


def events_by_type(silver: DataFrame) -> DataFrame:
    """Event count per type (the timed group-by of the local baseline)."""
    return silver.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
