"""Ordered session funnel View -> Cart -> Purchase.

``first_touch`` (default, as coded in the reference): compare the first cart
with the first view and the first purchase with the first cart; ties count.
``any_after`` (the documented intent): a session reaches Cart when some cart
is at/after its first view, and Purchase when some purchase is at/after the
first such cart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import safe_rate_sql

MODES = ("first_touch", "any_after")
# Fixed stage labels of the funnel table.
STAGES = ("View sessions", "Cart sessions", "Purchase sessions")


def first_touch(silver: DataFrame) -> DataFrame:
    """Per session: first view, cart and purchase time (null when absent).

    Built over all clean events, so its row count is the number of sessions.
    """
    return silver.groupBy("user_session").agg(
        *[F.expr(f"min(CASE WHEN event_type = '{t}' THEN event_time END) AS first_{t}")
          for t in ("view", "cart", "purchase")])


def funnel_flags(first: DataFrame) -> DataFrame:
    reached_cart = "first_view IS NOT NULL AND first_cart IS NOT NULL AND first_cart >= first_view"
    return first.selectExpr(
        "*", "first_view IS NOT NULL AS has_view",
        f"coalesce({reached_cart}, false) AS reached_cart",
        f"coalesce({reached_cart} AND first_purchase IS NOT NULL AND first_purchase >= first_cart, false)"
        " AS reached_purchase")


def session_flags_any_after(silver: DataFrame) -> DataFrame:
    """Per session flags for ``any_after``.

    With fv = first view, the session reaches Cart iff its last cart is at
    or after fv, and reaches Purchase iff some purchase is at or after the
    first cart c* >= fv — which holds exactly when some cart lies in
    [fv, last purchase] (then c* <= that cart <= last purchase; conversely
    c* itself lies there). So: one per-session aggregate, and one pass of
    the cart events joined to it on the session key (co-partitioned; AQE
    splits a hot session); no window over a whole session.
    """
    per_session = silver.groupBy("user_session").agg(
        F.expr("min(CASE WHEN event_type = 'view' THEN event_time END) AS fv"),
        F.expr("max(CASE WHEN event_type = 'cart' THEN event_time END) AS last_cart"),
        F.expr("max(CASE WHEN event_type = 'purchase' THEN event_time END) AS last_purchase"),
    ).filter("fv IS NOT NULL")
    carts = silver.filter("event_type = 'cart'").selectExpr("user_session", "event_time AS t")
    bought = (carts.join(per_session, "user_session")
              .filter("t >= fv AND t <= last_purchase")
              .select("user_session").distinct()
              .withColumn("reached_purchase", F.lit(True)))
    return (per_session.join(bought, "user_session", "left")
            .selectExpr("user_session", "true AS has_view",
                        "coalesce(last_cart >= fv, false) AS reached_cart",
                        "coalesce(reached_purchase, false) AS reached_purchase"))


def session_flags(silver: DataFrame, mode: str = "first_touch") -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if mode == "first_touch":
        return funnel_flags(first_touch(silver))
    return session_flags_any_after(silver)


def funnel_counts(flags: DataFrame) -> DataFrame:
    """One row: view_sessions, cart_sessions, purchase_sessions."""
    return flags.agg(F.expr("count_if(has_view) AS view_sessions"),
                     F.expr("count_if(reached_cart) AS cart_sessions"),
                     F.expr("count_if(reached_purchase) AS purchase_sessions"))


def funnel_from_counts(counts: DataFrame) -> DataFrame:
    """Three stage rows from the one-row counts (``stack``); stays on the executors."""
    v, c, p = "view_sessions", "cart_sessions", "purchase_sessions"
    stages = [(1, STAGES[0], v, "100.0"), (2, STAGES[1], c, safe_rate_sql(c, v)),
              (3, STAGES[2], p, safe_rate_sql(p, c))]
    args = ", ".join(
        f"{order}, '{label}', CAST({n} AS BIGINT), CAST({safe_rate_sql(n, v)} AS DOUBLE), CAST({prev} AS DOUBLE)"
        for order, label, n, prev in stages)
    return counts.selectExpr(
        f"stack(3, {args}) AS (stage_order, stage, sessions, percent_of_view_sessions, "
        "conversion_from_previous_stage_pct)")


def conversion_funnel(silver: DataFrame, mode: str = "first_touch") -> DataFrame:
    """Gold table 2."""
    return funnel_from_counts(funnel_counts(session_flags(silver, mode)))
