"""Registry of compared queries: Spark callable ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, the DuckDB oracle text.

Every query starts from the whole ``events`` and ``part`` tables (the
click-stream fixture) and runs the real operator; nothing is sampled,
capped or filtered by id. Floating columns are rounded to 4 decimals on both
sides of the comparison only (sums of doubles differ in the last bits with
summation order); the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickvault.functions.columns import event_type_is_valid, is_invalid_price, iso_text, safe_rate, seconds_between, to_id
from clickvault.operators import abandonment as AB
from clickvault.operators import category as CA
from clickvault.operators import engagement as EN
from clickvault.operators import figures as FG
from clickvault.operators import funnel as FU
from clickvault.operators import kpi as KP
from clickvault.operators import quality as Q
from clickvault.operators import serving as SV
from clickvault.plans import oracle as O
from clickvault.plans.job import gold_tables
from clickvault.schemas import RAW_COLUMNS
from clickvault.sources.tables import raw_events

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
DIGITS = 4


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round floating columns for the comparison only."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def sql_rounded(select: str, doubles: tuple[str, ...] = ()) -> str:
    if not doubles:
        return select
    rep = ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{select}\n)"


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql_rounded(sql, doubles)
        return run
    return deco


# ----------------------------------------------------------------- helpers
def _raw(spark, sf):
    return raw_events(spark, sf)


def _tagged(spark, sf, dedupe="raw"):
    return Q.tag(_raw(spark, sf), dedupe=dedupe)


def _silver(spark, sf, dedupe="raw"):
    return Q.silver(_tagged(spark, sf, dedupe))


def _w(*ctes_and_select) -> str:
    *ctes, select = ctes_and_select
    flat: list[str] = []
    for c in ctes:
        flat.extend(c if isinstance(c, list) else [c])
    return O.with_(flat, select)


FX = O.fixture_ctes()
TG = O.fixture_ctes() + O.tagged_ctes("raw")
TGN = O.fixture_ctes() + O.tagged_ctes("normalised")
SL = O.silver_ctes("raw")
GOLD = O.gold_ctes("raw")
ROW = "source_row_number"

# ============================================================ §2.3 cleaning


@register("parse_event_time", _w(FX, """SELECT source_row_number, event_time,
  try_strptime(event_time, '%Y-%m-%d %H:%M:%S UTC') AS parsed_event_time FROM raw"""))
def q_parse_event_time(spark, sf):
    raw = _raw(spark, sf)
    return Q.with_parsed(raw).select(ROW, "event_time", F.col("_t").alias("parsed_event_time"))


@register("normalise_event_type", _w(FX, f"""SELECT source_row_number, event_type,
  lower(trim(event_type, {O.BLANKS_SQL})) AS normalised_event_type FROM raw"""))
def q_normalise_event_type(spark, sf):
    return Q.with_parsed(_raw(spark, sf)).select(ROW, "event_type", F.col("_et").alias("normalised_event_type"))


@register("parse_price", _w(FX, """SELECT source_row_number, price,
  try_cast(price AS DOUBLE) AS parsed_price FROM raw"""), doubles=("parsed_price",))
def q_parse_price(spark, sf):
    return Q.with_parsed(_raw(spark, sf)).select(ROW, "price", F.col("_p").alias("parsed_price"))


_RAWCOLS = ", ".join(RAW_COLUMNS)


@register("dedupe_raw", _w(TG, f"SELECT source_row_number, {_RAWCOLS} FROM ranked WHERE _copy > 1"))
def q_dedupe_raw(spark, sf):
    marked = Q.mark_duplicates(_raw(spark, sf), RAW_COLUMNS)
    return marked.filter("_is_duplicate").select(ROW, *RAW_COLUMNS)


@register("dedupe_normalised", _w(TGN, f"SELECT source_row_number, {_RAWCOLS} FROM ranked WHERE _copy > 1"))
def q_dedupe_normalised(spark, sf):
    parsed = Q.with_parsed(_raw(spark, sf))
    marked = Q.mark_duplicates(parsed, Q._NORMALISED_KEYS)
    return marked.filter("_is_duplicate").select(ROW, *RAW_COLUMNS)


@register("filter_time", _w(TG, "SELECT source_row_number, event_time FROM parsed WHERE _t IS NOT NULL"))
def q_filter_time(spark, sf):
    return Q.with_parsed(_raw(spark, sf)).filter(F.col("_t").isNotNull()).select(ROW, "event_time")


@register("filter_event_domain", _w(TG, """SELECT source_row_number, event_type FROM parsed
  WHERE coalesce(_et IN ('view', 'cart', 'remove_from_cart', 'purchase'), false)"""))
def q_filter_event_domain(spark, sf):
    return (Q.with_parsed(_raw(spark, sf)).filter(event_type_is_valid(F.col("_et")))
            .select(ROW, "event_type"))


@register("filter_identifiers", _w(FX, """SELECT source_row_number, product_id, user_id, user_session
  FROM raw WHERE try_cast(product_id AS BIGINT) IS NOT NULL AND try_cast(user_id AS BIGINT) IS NOT NULL
  AND user_session IS NOT NULL"""))
def q_filter_identifiers(spark, sf):
    ok = to_id("product_id").isNotNull() & to_id("user_id").isNotNull() & F.col("user_session").isNotNull()
    return _raw(spark, sf).filter(ok).select(ROW, "product_id", "user_id", "user_session")


@register("filter_price", _w(TG, """SELECT source_row_number, price, _p AS parsed_price FROM parsed
  WHERE _p IS NOT NULL AND NOT isnan(_p) AND _p > 0"""), doubles=("parsed_price",))
def q_filter_price(spark, sf):
    p = F.col("_p")
    return (Q.with_parsed(_raw(spark, sf)).filter(~is_invalid_price(p) & (p > 0))
            .select(ROW, "price", p.alias("parsed_price")))


@register("reject_reason", _w(TG, "SELECT source_row_number, rejection_reason FROM tagged"))
def q_reject_reason(spark, sf):
    return _tagged(spark, sf).select(ROW, Q.REASON)


@register("rejected_records", _w(TG, f"""SELECT source_row_number, {_RAWCOLS}, rejection_reason
  FROM tagged WHERE rejection_reason IS NOT NULL"""))
def q_rejected_records(spark, sf):
    return Q.rejected_records(_tagged(spark, sf))


@register("reject_preview", _w(TG, """SELECT source_row_number, event_type, price, user_session, rejection_reason,
  (SELECT CAST(greatest(count(*) - 20, 0) AS BIGINT) FROM tagged WHERE rejection_reason IS NOT NULL)
    AS additional_rejected_rows
  FROM tagged WHERE rejection_reason IS NOT NULL ORDER BY source_row_number LIMIT 20"""))
def q_reject_preview(spark, sf):
    return Q.reject_preview(_tagged(spark, sf))


@register("fill_unknown", _w(TG, """SELECT source_row_number, coalesce(brand, 'unknown') AS brand,
  coalesce(category_code, 'unknown') AS category_code FROM tagged WHERE rejection_reason IS NULL"""))
def q_fill_unknown(spark, sf):
    t = _tagged(spark, sf).filter(F.col(Q.REASON).isNull())
    return t.fillna({"brand": "unknown", "category_code": "unknown"}).select(ROW, "brand", "category_code")


@register("derive_time_parts", _w(TG, """SELECT source_row_number, CAST(_t AS DATE) AS event_date,
  CAST(hour(_t) AS INTEGER) AS event_hour, strftime(_t, '%A') AS event_day, strftime(_t, '%Y-%m') AS event_month
  FROM tagged WHERE rejection_reason IS NULL"""))
def q_derive_time_parts(spark, sf):
    t = _tagged(spark, sf).filter(F.col(Q.REASON).isNull())
    ts = F.col("_t")
    return t.select(ROW, F.to_date(ts).alias("event_date"), F.hour(ts).alias("event_hour"),
                    F.date_format(ts, "EEEE").alias("event_day"), F.date_format(ts, "yyyy-MM").alias("event_month"))


@register("silver_events", _w(SL, "SELECT * FROM silver"), doubles=("price",))
def q_silver_events(spark, sf):
    return _silver(spark, sf)


@register("silver_events_normalised", _w(O.silver_ctes("normalised"), "SELECT * FROM silver"),
          doubles=("price",))
def q_silver_events_normalised(spark, sf):
    return _silver(spark, sf, "normalised")


def _report_sql(tg):
    reasons = [("duplicate_rows_removed", "duplicate_record"),
               ("unsupported_event_type_rows_removed", "unsupported_event_type"),
               ("invalid_event_time_rows_removed", "invalid_event_time"),
               ("missing_required_identifier_rows_removed", "missing_required_identifier"),
               ("invalid_price_rows_removed", "invalid_price"),
               ("nonpositive_price_rows_removed", "nonpositive_price")]
    parts = ["SELECT 'raw_rows' AS metric, count(*) AS value FROM tagged"]
    parts += [f"SELECT '{m}', count_if(rejection_reason = '{r}') FROM tagged" for m, r in reasons]
    parts += ["SELECT 'clean_rows', count_if(rejection_reason IS NULL) FROM tagged",
              "SELECT 'removed_rows', count_if(rejection_reason IS NOT NULL) FROM tagged"]
    return _w(tg, "\nUNION ALL ".join(parts))


@register("quality_report", _report_sql(TG))
def q_quality_report(spark, sf):
    return Q.quality_report(_tagged(spark, sf))


@register("quality_report_normalised", _report_sql(TGN))
def q_quality_report_normalised(spark, sf):
    return Q.quality_report(_tagged(spark, sf, "normalised"))


@register("filter_chain")
def q_filter_chain(spark, sf):
    """Un-audited normalise/distinct/filter chain of the timing runs (rows only:
    same row count as ``silver_events_normalised``)."""
    return Q.filter_chain(_raw(spark, sf))


# ================================================================ §2.4 Gold
_UA = O.silver_ctes("raw") + O.engagement_ctes()


@register("crosstab_user_event", _w(_UA, "SELECT user_id, views, carts, purchases, remove_from_cart FROM users"))
def q_crosstab_user_event(spark, sf):
    return EN.user_activity(_silver(spark, sf)).select("user_id", "views", "carts", "purchases", "remove_from_cart")


@register("user_sessions", _w(_UA, "SELECT user_id, sessions FROM users"))
def q_user_sessions(spark, sf):
    return _silver(spark, sf).groupBy("user_id").agg(F.countDistinct("user_session").alias("sessions"))


@register("user_purchase_value", _w(_UA, "SELECT user_id, purchase_value FROM users"), doubles=("purchase_value",))
def q_user_purchase_value(spark, sf):
    return _silver(spark, sf).groupBy("user_id").agg(CA.purchase_sum().alias("purchase_value"))


@register("join_fill_zero", _w(_UA, """SELECT u.user_id, u.views, u.carts, u.purchases, u.remove_from_cart,
  coalesce(p.purchase_value, 0.0) AS purchase_value
  FROM users u LEFT JOIN (SELECT user_id, sum(price) AS purchase_value FROM silver
                          WHERE event_type = 'purchase' GROUP BY user_id) p ON u.user_id = p.user_id"""),
          doubles=("purchase_value",))
def q_join_fill_zero(spark, sf):
    s = _silver(spark, sf)
    counts = EN.user_activity(s).select("user_id", "views", "carts", "purchases", "remove_from_cart")
    value = (s.filter(F.col("event_type") == "purchase").groupBy("user_id")
             .agg(F.sum("price").alias("purchase_value")))
    return EN.join_fill_zero(counts, value, "user_id")


@register("total_interactions", _w(_UA, "SELECT user_id, total_interactions FROM users"))
def q_total_interactions(spark, sf):
    return EN.user_activity(_silver(spark, sf)).select("user_id", "total_interactions")


@register("engagement_score", _w(_UA, "SELECT user_id, engagement_score FROM users"))
def q_engagement_score(spark, sf):
    return EN.user_activity(_silver(spark, sf)).select("user_id", "engagement_score")


@register("engagement_thresholds", _w(_UA, "SELECT users, q33, q67 FROM thresholds"), doubles=("q33", "q67"))
def q_engagement_thresholds(spark, sf):
    return EN.engagement_thresholds(EN.user_activity(_silver(spark, sf)))


@register("engagement_thresholds_approx")
def q_engagement_thresholds_approx(spark, sf):
    """Greenwald-Khanna thresholds (rows only: a sketch has no SQL twin)."""
    return EN.engagement_thresholds(EN.user_activity(_silver(spark, sf)), "approx")


@register("approx_threshold_error", """SELECT unnest([0.33, 0.67])::DOUBLE AS quantile, true AS within""", doubles=("quantile",))
def q_approx_threshold_error(spark, sf):
    """The approximate thresholds' true ranks lie within the sketch's error."""
    return EN.approx_threshold_errors(EN.user_activity(_silver(spark, sf))).select("quantile", "within")


@register("event_time_iso", _w(SL, """SELECT user_session, strftime(min(event_time), '%Y-%m-%dT%H:%M:%S+00:00') AS first_event,
  strftime(max(event_time), '%Y-%m-%dT%H:%M:%S+00:00') AS last_event,
  CAST(epoch_us(max(event_time)) - epoch_us(min(event_time)) AS DOUBLE) / 1e6 AS seconds FROM silver GROUP BY user_session"""), doubles=("seconds",))
def q_event_time_iso(spark, sf):
    """First and last event of each session as ISO text, and the seconds between them."""
    spans = _silver(spark, sf).groupBy("user_session").agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    return spans.select("user_session", iso_text("lo").alias("first_event"), iso_text("hi").alias("last_event"),
                        seconds_between("lo", "hi").alias("seconds"))


@register("engagement_level", _w(_UA, "SELECT user_id, engagement_level FROM customer_engagement"))
def q_engagement_level(spark, sf):
    return EN.customer_engagement(_silver(spark, sf)).select("user_id", "engagement_level")


@register("customer_engagement", _w(_UA, "SELECT * FROM customer_engagement"), doubles=("purchase_value",))
def q_customer_engagement(spark, sf):
    return EN.customer_engagement(_silver(spark, sf))


@register("customer_engagement_approx")
def q_customer_engagement_approx(spark, sf):
    """Levels from the approximate thresholds (rows only)."""
    return EN.customer_engagement(_silver(spark, sf), "approx")


_FT = O.silver_ctes("raw") + O.funnel_ctes("first_touch")


@register("first_touch", _w(_FT, """SELECT user_session, fv AS first_view, fc AS first_cart,
  fp AS first_purchase FROM ft"""))
def q_first_touch(spark, sf):
    return FU.first_touch(_silver(spark, sf))


@register("funnel_flags", _w(_FT, "SELECT user_session, has_view, reached_cart, reached_purchase FROM flags"))
def q_funnel_flags(spark, sf):
    return FU.session_flags(_silver(spark, sf)).select("user_session", "has_view", "reached_cart", "reached_purchase")


_FUNNEL_D = ("percent_of_view_sessions", "conversion_from_previous_stage_pct")


@register("conversion_funnel", _w(_FT, "SELECT * FROM conversion_funnel"), doubles=_FUNNEL_D)
def q_conversion_funnel(spark, sf):
    return FU.conversion_funnel(_silver(spark, sf))


@register("conversion_funnel_any_after",
          _w(O.silver_ctes("raw") + O.funnel_ctes("any_after"), "SELECT * FROM conversion_funnel"),
          doubles=_FUNNEL_D)
def q_conversion_funnel_any_after(spark, sf):
    return FU.conversion_funnel(_silver(spark, sf), "any_after")


@register("safe_rate", _w(SL, f"""SELECT event_hour, count_if(event_type = 'view') AS views,
  count_if(event_type = 'purchase') AS purchases,
  {O.rate("count_if(event_type = 'purchase')", "count_if(event_type = 'view')")} AS purchase_per_view_pct
  FROM silver GROUP BY event_hour"""), doubles=("purchase_per_view_pct",))
def q_safe_rate(spark, sf):
    t = F.col("event_type")
    hourly = _silver(spark, sf).groupBy("event_hour").agg(
        F.count_if(t == "view").alias("views"), F.count_if(t == "purchase").alias("purchases"))
    return hourly.select("*", safe_rate(F.col("purchases"), F.col("views")).alias("purchase_per_view_pct"))


_AB = O.silver_ctes("raw") + O.abandonment_ctes()


@register("session_category_flags", _w(_AB, """SELECT user_session, category_code, carts, purchases, removes,
  carts > 0 AS had_cart, purchases > 0 AS had_purchase, carts > 0 AND purchases = 0 AS abandoned FROM pairs"""))
def q_session_category_flags(spark, sf):
    return AB.session_category_flags(_silver(spark, sf)).select(
        "user_session", "category_code", "carts", "purchases", "removes", "had_cart", "had_purchase", "abandoned")


@register("cart_abandonment", _w(_AB, "SELECT * FROM cart_abandonment"), doubles=("abandonment_rate_pct",))
def q_cart_abandonment(spark, sf):
    return AB.cart_abandonment(_silver(spark, sf))


_CP = O.silver_ctes("raw") + [O.category_performance_cte()]
_CP_D = ("purchase_revenue", "view_to_cart_rate_pct", "purchase_conversion_rate_pct")


@register("category_counts", _w(_CP, """SELECT category_code, views, cart_additions, purchases,
  remove_from_cart_events FROM category_performance"""))
def q_category_counts(spark, sf):
    return CA.category_counts(_silver(spark, sf))


@register("category_revenue", _w(_CP, "SELECT category_code, purchase_revenue FROM category_performance"),
          doubles=("purchase_revenue",))
def q_category_revenue(spark, sf):
    return CA.category_revenue(_silver(spark, sf))


@register("category_rates", _w(_CP, """SELECT category_code, view_to_cart_rate_pct, purchase_conversion_rate_pct
  FROM category_performance"""), doubles=_CP_D[1:])
def q_category_rates(spark, sf):
    return CA.with_category_rates(CA.category_counts(_silver(spark, sf))).select(
        "category_code", "view_to_cart_rate_pct", "purchase_conversion_rate_pct")


@register("category_performance", _w(_CP, "SELECT * FROM category_performance"), doubles=_CP_D)
def q_category_performance(spark, sf):
    return CA.category_performance(_silver(spark, sf))


@register("category_performance_from_pairs", _w(_CP, "SELECT * FROM category_performance"), doubles=_CP_D)
def q_category_performance_from_pairs(spark, sf):
    """The job's shared-scan form: category table re-aggregated from the
    session x category pairs that also feed abandonment."""
    return CA.category_performance_from_pairs(AB.session_category_flags(_silver(spark, sf)))


def gold_bundle(silver: DataFrame) -> dict[str, DataFrame]:
    """The six Gold tables (uncached: each registered query runs once)."""
    return gold_tables(silver, share=False)


@register("kpi_summary", _w(GOLD, O.kpi_cte(), "SELECT * FROM kpi_summary"), doubles=("value",))
def q_kpi_summary(spark, sf):
    return gold_bundle(_silver(spark, sf))["kpi_summary"]


def _definitions_sql() -> str:
    rows = []
    for m, d in KP.DEFINITIONS:
        text = "'" + d.replace("'", "''") + "'"
        text = text.replace("{q33}", "' || printf('%g', q33) || '").replace("{q67}", "' || printf('%g', q67) || '")
        rows.append(f"SELECT '{m}' AS metric, {text} AS definition FROM thresholds")
    return "\nUNION ALL ".join(rows)


@register("metric_definitions", _w(_UA, _definitions_sql()))
def q_metric_definitions(spark, sf):
    return KP.metric_definitions(EN.engagement_thresholds(EN.user_activity(_silver(spark, sf))))


@register("events_by_type", _w(SL, "SELECT event_type, count(*) AS events FROM silver GROUP BY event_type"))
def q_events_by_type(spark, sf):
    return CA.events_by_type(_silver(spark, sf))


# ======================================================== §2.5 serving SQL
_SERVING_DOUBLES = {
    "sql_top_engagement": ("purchase_value",),
    "sql_funnel": _FUNNEL_D,
    "sql_top_abandonment": ("abandonment_rate_pct",),
    "sql_top_revenue": _CP_D,
    "sql_total_revenue": ("total_purchase_revenue",),
    "sql_top_conversion": ("purchase_conversion_rate_pct",),
}


def register_gold_views(spark: SparkSession, silver: DataFrame) -> dict[str, DataFrame]:
    gold = gold_bundle(silver)
    for name in SV.SERVING_TABLES:
        gold[name].createOrReplaceTempView(name)
    return gold


def _serving_query(name: str) -> QueryFn:
    def fn(spark, sf):
        register_gold_views(spark, _silver(spark, sf))
        return spark.sql(SV.SERVING_SQL[name])
    fn.__name__ = f"q_{name}"
    return fn


for _name, _text in SV.SERVING_SQL.items():
    register(_name, _w(GOLD, _text), doubles=_SERVING_DOUBLES[_name])(_serving_query(_name))


# ========================================================= §2.6 figures
_REASON_LABEL_SQL = "\nUNION ALL ".join(
    f"SELECT '{label}' AS reason, count_if(rejection_reason = '{reason}') AS removed_records FROM tagged"
    for label, reason in (("Duplicate", "duplicate_record"), ("Unsupported event", "unsupported_event_type"),
                          ("Missing identifier", "missing_required_identifier"),
                          ("Non-positive price", "nonpositive_price")))


@register("fig01_cleaning", _w(TG, """SELECT count(*) AS raw_rows, count_if(rejection_reason IS NULL) AS clean_rows
  FROM tagged"""))
def q_fig01(spark, sf):
    return FG.fig01_cleaning(Q.quality_report(_tagged(spark, sf)))


@register("fig02_reject_reasons", _w(TG, _REASON_LABEL_SQL))
def q_fig02(spark, sf):
    return FG.fig02_reject_reasons(Q.quality_report(_tagged(spark, sf)))


@register("fig03_funnel", _w(_FT, """SELECT stage_order, stage, sessions, round(percent_of_view_sessions, 1) AS label_pct
  FROM conversion_funnel"""), doubles=("label_pct",))
def q_fig03(spark, sf):
    return FG.fig03_funnel(FU.conversion_funnel(_silver(spark, sf)))


@register("fig04_stage_rates", _w(_FT, """SELECT CASE stage_order WHEN 2 THEN 'View -> Cart' ELSE 'Cart -> Purchase' END
  AS stage, conversion_from_previous_stage_pct FROM conversion_funnel WHERE stage_order > 1"""),
          doubles=("conversion_from_previous_stage_pct",))
def q_fig04(spark, sf):
    return FG.fig04_stage_rates(FU.conversion_funnel(_silver(spark, sf)))


@register("fig05_revenue", _w(_CP, "SELECT category_code, purchase_revenue FROM category_performance"),
          doubles=("purchase_revenue",))
def q_fig05(spark, sf):
    return FG.fig05_revenue(CA.category_performance(_silver(spark, sf)))


@register("fig06_rates", _w(_CP, """SELECT category_code, view_to_cart_rate_pct, purchase_conversion_rate_pct
  FROM category_performance"""), doubles=_CP_D[1:])
def q_fig06(spark, sf):
    return FG.fig06_rates(CA.category_performance(_silver(spark, sf)))


@register("fig07_abandonment_rate", _w(_AB, "SELECT category_code, abandonment_rate_pct FROM cart_abandonment"),
          doubles=("abandonment_rate_pct",))
def q_fig07(spark, sf):
    return FG.fig07_abandonment_rate(AB.cart_abandonment(_silver(spark, sf)))


@register("fig08_cart_vs_abandoned", _w(_AB, """SELECT category_code, cart_sessions, abandoned_sessions
  FROM cart_abandonment"""))
def q_fig08(spark, sf):
    return FG.fig08_cart_vs_abandoned(AB.cart_abandonment(_silver(spark, sf)))


_LEVELS_SQL = "(VALUES ('Low'), ('Medium'), ('High')) AS l(engagement_level)"


@register("fig09_level_distribution", _w(_UA, f"""SELECT l.engagement_level,
  (SELECT count(*) FROM customer_engagement c WHERE c.engagement_level = l.engagement_level) AS customers
  FROM {_LEVELS_SQL}"""))
def q_fig09(spark, sf):
    return FG.fig09_level_distribution(EN.customer_engagement(_silver(spark, sf)))


@register("fig10_top15", _w(_UA, """SELECT user_id, engagement_score FROM customer_engagement
  ORDER BY engagement_score DESC, user_id LIMIT 15"""))
def q_fig10(spark, sf):
    return FG.fig10_top15(EN.customer_engagement(_silver(spark, sf)))


@register("fig11_avg_value", _w(_UA, f"""SELECT l.engagement_level,
  coalesce((SELECT avg(purchase_value) FROM customer_engagement c WHERE c.engagement_level = l.engagement_level), 0.0)
    AS avg_purchase_value
  FROM {_LEVELS_SQL}"""), doubles=("avg_purchase_value",))
def q_fig11(spark, sf):
    return FG.fig11_avg_value(EN.customer_engagement(_silver(spark, sf)))


@register("fig12_event_types", _w(SL, "\nUNION ALL ".join(
    f"SELECT '{e}' AS event_type, count_if(event_type = '{e}') AS events FROM silver"
    for e in ("view", "cart", "remove_from_cart", "purchase"))))
def q_fig12(spark, sf):
    return FG.fig12_event_types(_silver(spark, sf))


@register("fig13_hourly", _w(SL, """SELECT event_hour,
  count_if(event_type = 'view' AND user_session IS NOT NULL) AS view,
  count_if(event_type = 'cart' AND user_session IS NOT NULL) AS cart,
  count_if(event_type = 'remove_from_cart' AND user_session IS NOT NULL) AS remove_from_cart,
  count_if(event_type = 'purchase' AND user_session IS NOT NULL) AS purchase
  FROM silver GROUP BY event_hour"""))
def q_fig13(spark, sf):
    return FG.fig13_hourly(_silver(spark, sf))


@register("fig14_daily_revenue", _w(SL, """SELECT event_date, sum(price) AS revenue FROM silver
  WHERE event_type = 'purchase' GROUP BY event_date"""), doubles=("revenue",))
def q_fig14(spark, sf):
    return FG.fig14_daily_revenue(_silver(spark, sf))


@register("fig15_event_mix", _w(_CP, """SELECT category_code, views, cart_additions, purchases, remove_from_cart_events,
  CAST(0 AS BIGINT) AS views_base, views AS cart_additions_base, views + cart_additions AS purchases_base,
  views + cart_additions + purchases AS remove_from_cart_events_base FROM category_performance"""))
def q_fig15(spark, sf):
    return FG.fig15_event_mix(CA.category_performance(_silver(spark, sf)))
