"""Explicit schemas (no ``inferSchema``: it costs a pass and drifts with data)."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference for right results:
# the nine raw column names in file order, the four supported event types,
# the rejection reasons in first-match order, and the quality report rows.
RAW_COLUMNS = (
    "event_time", "event_type", "product_id", "category_id",
    "category_code", "brand", "price", "user_id", "user_session",
)
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
REASONS = (
    "duplicate_record",
    "invalid_event_time",
    "unsupported_event_type",
    "missing_required_identifier",
    "invalid_price",
    "nonpositive_price",
)
# report metric names, in report order (order differs from REASONS)
REPORT_REASON_ORDER = (
    ("duplicate_rows_removed", "duplicate_record"),
    ("unsupported_event_type_rows_removed", "unsupported_event_type"),
    ("invalid_event_time_rows_removed", "invalid_event_time"),
    ("missing_required_identifier_rows_removed", "missing_required_identifier"),
    ("invalid_price_rows_removed", "invalid_price"),
    ("nonpositive_price_rows_removed", "nonpositive_price"),
)
LEVELS = ("Low", "Medium", "High")
DEFAULT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"

BRONZE = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

SILVER = T.StructType([
    T.StructField("event_time", T.TimestampType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("category_id", T.LongType(), True),
    T.StructField("category_code", T.StringType(), False),
    T.StructField("brand", T.StringType(), False),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("user_session", T.StringType(), True),
    T.StructField("event_date", T.DateType(), True),
    T.StructField("event_hour", T.IntegerType(), True),
    T.StructField("event_day", T.StringType(), True),
    T.StructField("event_month", T.StringType(), True),
])

# Serving tables: the types of the serving DDL (INT -> int, FLOAT -> double).
SERVING = {
    "customer_engagement": T.StructType([
        T.StructField("user_id", T.LongType()),
        T.StructField("views", T.IntegerType()),
        T.StructField("carts", T.IntegerType()),
        T.StructField("purchases", T.IntegerType()),
        T.StructField("remove_from_cart", T.IntegerType()),
        T.StructField("sessions", T.IntegerType()),
        T.StructField("purchase_value", T.DoubleType()),
        T.StructField("total_interactions", T.IntegerType()),
        T.StructField("engagement_score", T.DoubleType()),
        T.StructField("engagement_level", T.StringType()),
    ]),
    "conversion_funnel": T.StructType([
        T.StructField("stage_order", T.IntegerType()),
        T.StructField("stage", T.StringType()),
        T.StructField("sessions", T.IntegerType()),
        T.StructField("percent_of_view_sessions", T.DoubleType()),
        T.StructField("conversion_from_previous_stage_pct", T.DoubleType()),
    ]),
    "cart_abandonment": T.StructType([
        T.StructField("category_code", T.StringType()),
        T.StructField("cart_sessions", T.IntegerType()),
        T.StructField("abandoned_sessions", T.IntegerType()),
        T.StructField("remove_from_cart_events", T.IntegerType()),
        T.StructField("abandonment_rate_pct", T.DoubleType()),
    ]),
    "category_performance": T.StructType([
        T.StructField("category_code", T.StringType()),
        T.StructField("views", T.IntegerType()),
        T.StructField("cart_additions", T.IntegerType()),
        T.StructField("purchases", T.IntegerType()),
        T.StructField("remove_from_cart_events", T.IntegerType()),
        T.StructField("purchase_revenue", T.DoubleType()),
        T.StructField("view_to_cart_rate_pct", T.DoubleType()),
        T.StructField("purchase_conversion_rate_pct", T.DoubleType()),
    ]),
}

MANIFEST = T.StructType([
    T.StructField("sample_size", T.LongType()),
    T.StructField("file", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("row_digest", T.StringType()),
    T.StructField("provenance", T.StringType()),
])

LEDGER = T.StructType([
    T.StructField("sample_size", T.LongType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("remote_path", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("run_start_utc", T.StringType()),
    T.StructField("run_end_utc", T.StringType()),
    T.StructField("pipeline_seconds", T.DoubleType()),
    T.StructField("pipeline_rows_per_sec", T.DoubleType()),
    T.StructField("activity_seconds", T.DoubleType()),
    T.StructField("activity_rows_per_sec", T.DoubleType()),
    T.StructField("run_output", T.StringType()),
    T.StructField("evidence_file", T.StringType()),
])

ACTIVITY = T.StructType([
    T.StructField("activity_name", T.StringType()),
    T.StructField("activity_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("run_output", T.StringType()),
    T.StructField("output", T.StringType()),
    T.StructField("error", T.StringType()),
])

RUN_EVIDENCE = T.StructType([
    T.StructField("scope", T.StringType()),
    T.StructField("captured_at_utc", T.StringType()),
    T.StructField("upload", T.StructType([
        T.StructField("remote_path", T.StringType()),
        T.StructField("uploaded_bytes", T.LongType()),
        T.StructField("etag", T.StringType()),
        T.StructField("last_modified", T.StringType()),
    ])),
    T.StructField("pipeline", T.StructType([
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("run_start", T.StringType()),
        T.StructField("run_end", T.StringType()),
        T.StructField("duration_in_ms", T.LongType()),
        T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
    ])),
    T.StructField("activities", T.ArrayType(ACTIVITY)),
    T.StructField("summary", LEDGER),
])
