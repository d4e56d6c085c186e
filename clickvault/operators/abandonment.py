"""Cart abandonment per category over session x category pairs.

A pair is abandoned when it has a cart event and no purchase event; time
order and remove_from_cart do not matter (as in the reference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import safe_rate_sql
from clickvault.operators.category import purchase_sum, type_count



def session_category_flags(silver: DataFrame) -> DataFrame:
    """Per (session, category): event counts, revenue and the three flags.

    Map-side partial aggregation first, so a hot session or category only
    ships one partial row per task.
    """
    return (
        silver.groupBy("user_session", "category_code").agg(
            type_count("view", "views"), type_count("cart", "carts"),
            type_count("purchase", "purchases"), type_count("remove_from_cart", "removes"),
            purchase_sum().alias("revenue"),
        )
        .selectExpr("*", "carts > 0 AS had_cart", "purchases > 0 AS had_purchase",
                    "carts > 0 AND purchases = 0 AS abandoned")
    )


def cart_abandonment_from_pairs(pairs: DataFrame) -> DataFrame:
    agg = pairs.groupBy("category_code").agg(
        F.expr("count_if(had_cart) AS cart_sessions"),
        F.expr("count_if(abandoned) AS abandoned_sessions"),
        F.expr("sum(removes) AS remove_from_cart_events"),
    )
    return agg.selectExpr("*", f"{safe_rate_sql('abandoned_sessions', 'cart_sessions')} AS abandonment_rate_pct")


def cart_abandonment(silver: DataFrame) -> DataFrame:
    """Gold table 3: every category with an event, rate 0.0 without carts."""
    return cart_abandonment_from_pairs(session_category_flags(silver))
