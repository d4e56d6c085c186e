"""KPI summary (17 metrics) and metric definitions.

Each source is a one-row aggregate over an already-needed table; the rows are
unpivoted and unioned, so nothing is joined and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import format_g_sql, safe_rate_sql


def _stack(one_row: DataFrame, items: list[tuple[int, str, str]]) -> DataFrame:
    """Unpivot a one-row frame with ``stack`` (one SQL expression)."""
    args = ", ".join(f"{o}, '{m}', CAST({v} AS DOUBLE)" for o, m, v in items)
    return one_row.selectExpr(f"stack({len(items)}, {args}) AS (_order, metric, value)")


def kpi_summary(silver: DataFrame, users: DataFrame, first_touch_flags: DataFrame,
                abandonment: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``(metric, value double)``.

    ``users``: per-user table (its row count = unique users);
    ``first_touch_flags``: per-session funnel flags over all events (row count
    = unique sessions); ``abandonment``: per-category table; ``thresholds``:
    one row (q33, q67). Distinct counts come from those tables, so no extra
    distinct aggregation runs.
    """
    ev = silver.agg(
        F.expr("count(1) AS n"),
        F.expr("count_if(event_type = 'view') AS v"), F.expr("count_if(event_type = 'cart') AS c"),
        F.expr("count_if(event_type = 'purchase') AS p"),
        F.expr("count_if(event_type = 'remove_from_cart') AS r"),
        F.expr("coalesce(sum(CASE WHEN event_type = 'purchase' THEN price END), 0.0) AS rev"),
    )
    u = users.agg(F.expr("count(1) AS n"))
    s = first_touch_flags.agg(
        F.expr("count(1) AS n"), F.expr("count_if(has_view) AS v"),
        F.expr("count_if(reached_cart) AS c"), F.expr("count_if(reached_purchase) AS p"))
    a = abandonment.agg(F.expr("coalesce(sum(cart_sessions), 0) AS cs"),
                        F.expr("coalesce(sum(abandoned_sessions), 0) AS ab"))
    parts = [
        _stack(ev, [(1, "clean_events", "n")]),
        _stack(u, [(2, "unique_users", "n")]),
        _stack(s, [(3, "unique_sessions", "n")]),
        _stack(ev, [(4, "view_events", "v"), (5, "cart_events", "c"), (6, "purchase_events", "p"),
                    (7, "remove_from_cart_events", "r"), (8, "purchase_revenue", "round(rev, 2)")]),
        _stack(s, [(9, "view_sessions", "v"), (10, "cart_sessions", "c"), (11, "purchase_sessions", "p"),
                   (12, "view_to_cart_session_rate_pct", f"round({safe_rate_sql('c', 'v')}, 4)"),
                   (13, "cart_to_purchase_session_rate_pct", f"round({safe_rate_sql('p', 'c')}, 4)"),
                   (14, "overall_session_conversion_rate_pct", f"round({safe_rate_sql('p', 'v')}, 4)")]),
        _stack(a, [(15, "overall_cart_abandonment_rate_pct", f"round({safe_rate_sql('ab', 'cs')}, 4)")]),
        _stack(thresholds, [(16, "engagement_q33_threshold", "q33"), (17, "engagement_q67_threshold", "q67")]),
    ]
    out = parts[0]
    for df in parts[1:]:
        out = out.union(df)
    return out.coalesce(1).sortWithinPartitions("_order").drop("_order")


# Fixed text of the definitions table (metric, definition); {q33}/{q67} are
# filled with the thresholds printed like Python's ``:g``.
DEFINITIONS = (
    ("Engagement score", "Views + (3 x Carts) + (5 x Purchases)"),
    ("Low engagement", "Engagement score <= 33rd percentile threshold ({q33})"),
    ("Medium engagement", "Engagement score > {q33} and <= 67th percentile threshold ({q67})"),
    ("High engagement", "Engagement score > 67th percentile threshold ({q67})"),
    ("Conversion funnel", "Distinct sessions reaching ordered stages View -> Cart -> Purchase using first event timestamps"),
    ("Cart abandonment", "Session/category has >=1 cart event and no purchase event in the same session/category"),
    ("remove_from_cart treatment", "Retained and reported, but does not independently define abandonment and has zero engagement-score weight"),
    ("Category views/carts/purchases", "Counts of view, cart and purchase events for each category_code"),
    ("View-to-cart rate", "Category cart events / category view events x 100"),
    ("Purchase conversion rate", "Category purchase events / category view events x 100"),
    ("Purchase revenue", "Sum(price) for purchase events; no quantity field exists, so each purchase event contributes price once"),
)


def _fill_sql(template: str) -> str:
    """Template text -> SQL concat of literals and ``:g``-formatted thresholds."""
    parts, rest = [], template
    while rest:
        hits = [(rest.find(k), k) for k in ("{q33}", "{q67}") if rest.find(k) >= 0]
        if not hits:
            parts.append(_sql_literal(rest))
            break
        i, key = min(hits)
        if i:
            parts.append(_sql_literal(rest[:i]))
        parts.append(format_g_sql(key[1:-1]))
        rest = rest[i + len(key):]
    return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0]


def _sql_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def metric_definitions(thresholds: DataFrame) -> DataFrame:
    """11 rows ``(metric, definition)`` from the one-row thresholds frame."""
    args = ", ".join(f"{_sql_literal(m)}, {_fill_sql(d)}" for m, d in DEFINITIONS)
    return thresholds.selectExpr(f"stack({len(DEFINITIONS)}, {args}) AS (metric, definition)")
