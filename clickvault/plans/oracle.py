"""Independent DuckDB SQL for every compared query.

the fixture is inlined as CTEs over the base tables, cleaning uses a window
``row_number()`` for duplicates (the Spark side uses an aggregate + join),
and Gold tables are plain GROUP BY queries.
"""

from __future__ import annotations

RAW = ("event_time", "event_type", "product_id", "category_id", "category_code",
       "brand", "price", "user_id", "user_session")
BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def rate(num: str, den: str) -> str:
    return f"CAST(CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) * 100.0 ELSE 0.0 END AS DOUBLE)"


def with_(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def fixture_ctes() -> list[str]:
    return [
        """fx_base AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, p.p_partkey AS k, p.p_type, p.p_brand
  FROM events e JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
)""",
        """fx_copies AS (
  SELECT b.*, d.dup FROM fx_base b JOIN (VALUES (0), (1), (2)) AS d(dup)
    ON d.dup = 0 OR (d.dup = 1 AND b.event_id % 211 = 17) OR (d.dup = 2 AND b.event_id % 223 = 29)
)""",
        """fx_typed AS (
  SELECT *, CASE event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'remove_from_cart'
              WHEN 'view' THEN (CASE WHEN event_id % 4 = 0 THEN '  View' ELSE 'view' END)
              ELSE event_type END AS base_type
  FROM fx_copies
)""",
        """raw AS (
  SELECT CAST(2 + event_id + 1000000000000000 * dup AS BIGINT) AS source_row_number,
    CASE WHEN event_id % 83 = 5 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S UTC') END AS event_time,
    CASE WHEN dup = 2 THEN upper(base_type) WHEN event_id % 103 = 21 THEN base_type || chr(9)
         ELSE base_type END AS event_type,
    CASE WHEN event_id % 89 = 7 THEN NULL ELSE CAST(k AS VARCHAR) END AS product_id,
    CAST(2053013555631882655 + k % 6 AS VARCHAR) AS category_id,
    CASE WHEN k % 10 = 3 THEN NULL ELSE p_type END AS category_code,
    CASE WHEN k % 7 = 2 THEN NULL ELSE p_brand END AS brand,
    CASE WHEN event_id % 101 = 9 THEN 'n/k' WHEN event_id % 107 = 31 THEN 'NaN'
         WHEN event_id % 97 = 11 THEN '-' || CAST(value AS VARCHAR)
         ELSE CAST(value AS VARCHAR) END AS price,
    CAST(user_id AS VARCHAR) AS user_id,
    CASE WHEN event_id % 79 = 13 THEN NULL
         ELSE 'u' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') END AS user_session
  FROM fx_typed
)""",
    ]


def tagged_ctes(dedupe: str = "raw", source: str = "raw") -> list[str]:
    if dedupe == "raw":
        part = ", ".join(f"r.{c}" for c in RAW)
    else:
        part = ("_t, _et, _p, r.product_id, r.category_id, r.category_code, r.brand, "
                "r.user_id, r.user_session")
    return [
        f"""parsed AS (
  SELECT r.*, try_strptime(r.event_time, '%Y-%m-%d %H:%M:%S UTC') AS _t,
    lower(trim(r.event_type, {BLANKS_SQL})) AS _et,
    try_cast(r.price AS DOUBLE) AS _p
  FROM {source} r
)""",
        f"""ranked AS (
  SELECT r.*, row_number() OVER (PARTITION BY {part} ORDER BY r.source_row_number) AS _copy
  FROM parsed r
)""",
        """tagged AS (
  SELECT *, CASE
      WHEN _copy > 1 THEN 'duplicate_record'
      WHEN _t IS NULL THEN 'invalid_event_time'
      WHEN NOT coalesce(_et IN ('view', 'cart', 'remove_from_cart', 'purchase'), false) THEN 'unsupported_event_type'
      WHEN try_cast(product_id AS BIGINT) IS NULL OR try_cast(user_id AS BIGINT) IS NULL
           OR user_session IS NULL THEN 'missing_required_identifier'
      WHEN _p IS NULL OR isnan(_p) THEN 'invalid_price'
      WHEN _p <= 0 THEN 'nonpositive_price'
    END AS rejection_reason
  FROM ranked
)""",
    ]


def silver_cte() -> str:
    return """silver AS (
  SELECT _t AS event_time, _et AS event_type,
    try_cast(product_id AS BIGINT) AS product_id, try_cast(category_id AS BIGINT) AS category_id,
    coalesce(category_code, 'unknown') AS category_code, coalesce(brand, 'unknown') AS brand,
    _p AS price, try_cast(user_id AS BIGINT) AS user_id, user_session,
    CAST(_t AS DATE) AS event_date, CAST(hour(_t) AS INTEGER) AS event_hour,
    strftime(_t, '%A') AS event_day, strftime(_t, '%Y-%m') AS event_month
  FROM tagged WHERE rejection_reason IS NULL
)"""


def silver_ctes(dedupe: str = "raw") -> list[str]:
    return fixture_ctes() + tagged_ctes(dedupe) + [silver_cte()]


# ---------------------------------------------------------------- Gold CTEs
def category_performance_cte() -> str:
    return f"""category_performance AS (
  SELECT category_code, views, cart_additions, purchases, remove_from_cart_events, purchase_revenue,
    {rate('cart_additions', 'views')} AS view_to_cart_rate_pct,
    {rate('purchases', 'views')} AS purchase_conversion_rate_pct
  FROM (
    SELECT category_code,
      count_if(event_type = 'view') AS views, count_if(event_type = 'cart') AS cart_additions,
      count_if(event_type = 'purchase') AS purchases,
      count_if(event_type = 'remove_from_cart') AS remove_from_cart_events,
      sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END) AS purchase_revenue
    FROM silver GROUP BY category_code
  )
)"""


def engagement_ctes(method: str = "exact") -> list[str]:
    if method == "exact":
        q = ("quantile_cont(engagement_score, 0.33) AS q33, "
             "quantile_cont(engagement_score, 0.67) AS q67")
    else:
        raise ValueError("only the exact thresholds have a DuckDB twin")
    return [
        """users AS (
  SELECT user_id, views, carts, purchases, remove_from_cart, sessions, purchase_value,
    views + carts + purchases + remove_from_cart AS total_interactions,
    views + 3 * carts + 5 * purchases AS engagement_score
  FROM (
    SELECT user_id, count_if(event_type = 'view') AS views, count_if(event_type = 'cart') AS carts,
      count_if(event_type = 'purchase') AS purchases,
      count_if(event_type = 'remove_from_cart') AS remove_from_cart,
      count(DISTINCT user_session) AS sessions,
      sum(CASE WHEN event_type = 'purchase' THEN price ELSE 0.0 END) AS purchase_value
    FROM silver GROUP BY user_id
  )
)""",
        f"""thr0 AS (
  SELECT count(*) AS users, {q}, median(engagement_score) AS med FROM users
)""",
        """thresholds AS (
  SELECT users,
    CASE WHEN users < 3 THEN coalesce(CAST(med AS DOUBLE), 0.0) ELSE q33 END AS q33,
    CASE WHEN users < 3 THEN coalesce(CAST(med AS DOUBLE), 0.0) ELSE q67 END AS q67
  FROM thr0
)""",
        """customer_engagement AS (
  SELECT u.*, CASE WHEN t.users < 3 THEN 'Medium' WHEN u.engagement_score <= t.q33 THEN 'Low'
                   WHEN u.engagement_score <= t.q67 THEN 'Medium' ELSE 'High' END AS engagement_level
  FROM users u CROSS JOIN thresholds t
)""",
    ]


def funnel_ctes(mode: str = "first_touch") -> list[str]:
    if mode == "first_touch":
        flags = [
            """ft AS (
  SELECT user_session,
    min(CASE WHEN event_type = 'view' THEN event_time END) AS fv,
    min(CASE WHEN event_type = 'cart' THEN event_time END) AS fc,
    min(CASE WHEN event_type = 'purchase' THEN event_time END) AS fp
  FROM silver GROUP BY user_session
)""",
            """flags AS (
  SELECT user_session, fv IS NOT NULL AS has_view,
    coalesce(fv IS NOT NULL AND fc IS NOT NULL AND fc >= fv, false) AS reached_cart,
    coalesce(fv IS NOT NULL AND fc IS NOT NULL AND fc >= fv AND fp IS NOT NULL AND fp >= fc, false)
      AS reached_purchase
  FROM ft
)""",
        ]
    else:
        # correlated formulation: some cart at/after the first view, then some
        # purchase at/after the earliest such cart
        flags = [
            """fview AS (
  SELECT user_session, min(event_time) AS fv FROM silver WHERE event_type = 'view' GROUP BY user_session
)""",
            """fcart AS (
  SELECT v.user_session, v.fv,
    (SELECT min(s.event_time) FROM silver s WHERE s.user_session = v.user_session
       AND s.event_type = 'cart' AND s.event_time >= v.fv) AS fc
  FROM fview v
)""",
            """flags AS (
  SELECT user_session, true AS has_view, fc IS NOT NULL AS reached_cart,
    fc IS NOT NULL AND EXISTS (SELECT 1 FROM silver s WHERE s.user_session = c.user_session
       AND s.event_type = 'purchase' AND s.event_time >= c.fc) AS reached_purchase
  FROM fcart c
)""",
        ]
    return flags + [
        """fcounts AS (
  SELECT count_if(has_view) AS v, count_if(reached_cart) AS c, count_if(reached_purchase) AS p FROM flags
)""",
        f"""conversion_funnel AS (
  SELECT 1 AS stage_order, 'View sessions' AS stage, v AS sessions,
         {rate('v', 'v')} AS percent_of_view_sessions,
         CAST(100.0 AS DOUBLE) AS conversion_from_previous_stage_pct FROM fcounts
  UNION ALL
  SELECT 2, 'Cart sessions', c, {rate('c', 'v')}, {rate('c', 'v')} FROM fcounts
  UNION ALL
  SELECT 3, 'Purchase sessions', p, {rate('p', 'v')}, {rate('p', 'c')} FROM fcounts
)""",
    ]


def abandonment_ctes() -> list[str]:
    return [
        """pairs AS (
  SELECT user_session, category_code, count_if(event_type = 'cart') AS carts,
    count_if(event_type = 'purchase') AS purchases, count_if(event_type = 'remove_from_cart') AS removes
  FROM silver GROUP BY user_session, category_code
)""",
        f"""cart_abandonment AS (
  SELECT category_code, cart_sessions, abandoned_sessions, remove_from_cart_events,
    {rate('abandoned_sessions', 'cart_sessions')} AS abandonment_rate_pct
  FROM (
    SELECT category_code, count_if(carts > 0) AS cart_sessions,
      count_if(carts > 0 AND purchases = 0) AS abandoned_sessions,
      CAST(sum(removes) AS BIGINT) AS remove_from_cart_events
    FROM pairs GROUP BY category_code
  )
)""",
    ]


def gold_ctes(dedupe: str = "raw") -> list[str]:
    return (silver_ctes(dedupe) + [category_performance_cte()] + engagement_ctes()
            + funnel_ctes() + abandonment_ctes())


def kpi_cte() -> str:
    return f"""kpi_summary AS (
  SELECT metric, CAST(value AS DOUBLE) AS value FROM (
    SELECT 1 AS o, 'clean_events' AS metric, CAST(count(*) AS DOUBLE) AS value FROM silver
    UNION ALL SELECT 2, 'unique_users', CAST(count(*) AS DOUBLE) FROM users
    UNION ALL SELECT 3, 'unique_sessions', CAST(count(*) AS DOUBLE) FROM ft
    UNION ALL SELECT 4, 'view_events', CAST(count_if(event_type = 'view') AS DOUBLE) FROM silver
    UNION ALL SELECT 5, 'cart_events', CAST(count_if(event_type = 'cart') AS DOUBLE) FROM silver
    UNION ALL SELECT 6, 'purchase_events', CAST(count_if(event_type = 'purchase') AS DOUBLE) FROM silver
    UNION ALL SELECT 7, 'remove_from_cart_events', CAST(count_if(event_type = 'remove_from_cart') AS DOUBLE) FROM silver
    UNION ALL SELECT 8, 'purchase_revenue',
      round(coalesce(sum(CASE WHEN event_type = 'purchase' THEN price END), 0.0), 2) FROM silver
    UNION ALL SELECT 9, 'view_sessions', CAST(v AS DOUBLE) FROM fcounts
    UNION ALL SELECT 10, 'cart_sessions', CAST(c AS DOUBLE) FROM fcounts
    UNION ALL SELECT 11, 'purchase_sessions', CAST(p AS DOUBLE) FROM fcounts
    UNION ALL SELECT 12, 'view_to_cart_session_rate_pct', round({rate('c', 'v')}, 4) FROM fcounts
    UNION ALL SELECT 13, 'cart_to_purchase_session_rate_pct', round({rate('p', 'c')}, 4) FROM fcounts
    UNION ALL SELECT 14, 'overall_session_conversion_rate_pct', round({rate('p', 'v')}, 4) FROM fcounts
    UNION ALL SELECT 15, 'overall_cart_abandonment_rate_pct',
      round({rate('sum(abandoned_sessions)', 'sum(cart_sessions)')}, 4) FROM cart_abandonment
    UNION ALL SELECT 16, 'engagement_q33_threshold', q33 FROM thresholds
    UNION ALL SELECT 17, 'engagement_q67_threshold', q67 FROM thresholds
  )
)"""
