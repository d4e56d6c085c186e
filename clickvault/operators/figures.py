"""The data step behind each chart (drawing is not built).

Inputs are Gold tables (a handful of rows per category or level) or Silver.
Zero-filled dimensions (levels, event types) come from ``count_if`` columns
unpivoted with ``inline``, not from a join against a literal table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.schemas import EVENT_TYPES, LEVELS
from clickvault.sources.tables import metric_lookup

# Fixed chart labels: removal reasons shown in the rejection chart (the two
# invalid_* reasons are not shown) and the relabelled funnel stages.
REASON_LABELS = (
    ("duplicate_rows_removed", "Duplicate"),
    ("unsupported_event_type_rows_removed", "Unsupported event"),
    ("missing_required_identifier_rows_removed", "Missing identifier"),
    ("nonpositive_price_rows_removed", "Non-positive price"),
)
STAGE_RATE_LABELS = {2: "View -> Cart", 3: "Cart -> Purchase"}


def _unpivot(one_row: DataFrame, key: str, value: str, items) -> DataFrame:
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias(key), v.alias(value)) for k, v in items
    ])))


def fig01_cleaning(report: DataFrame) -> DataFrame:
    return metric_lookup(report, ["raw_rows", "clean_rows"]).select(
        F.col("raw_rows").cast("bigint").alias("raw_rows"),
        F.col("clean_rows").cast("bigint").alias("clean_rows"))


def fig02_reject_reasons(report: DataFrame) -> DataFrame:
    wide = metric_lookup(report, [m for m, _ in REASON_LABELS], default=0)
    return _unpivot(wide, "reason", "removed_records",
                    [(label, F.col(m).cast("bigint")) for m, label in REASON_LABELS])


def fig03_funnel(funnel: DataFrame) -> DataFrame:
    return funnel.select("stage_order", "stage", "sessions",
                         F.round("percent_of_view_sessions", 1).alias("label_pct")).orderBy("stage_order")


def fig04_stage_rates(funnel: DataFrame) -> DataFrame:
    label = F.when(F.col("stage_order") == 2, F.lit(STAGE_RATE_LABELS[2])) \
        .when(F.col("stage_order") == 3, F.lit(STAGE_RATE_LABELS[3]))
    return (funnel.filter(F.col("stage_order") > 1)
            .select(label.alias("stage"), "conversion_from_previous_stage_pct").orderBy("stage_order"))


def fig05_revenue(category: DataFrame) -> DataFrame:
    return category.select("category_code", "purchase_revenue").orderBy("purchase_revenue", "category_code")


def fig06_rates(category: DataFrame) -> DataFrame:
    return (category.select("category_code", "view_to_cart_rate_pct", "purchase_conversion_rate_pct")
            .orderBy(F.desc("purchase_conversion_rate_pct"), "category_code"))


def fig07_abandonment_rate(abandonment: DataFrame) -> DataFrame:
    return (abandonment.select("category_code", "abandonment_rate_pct")
            .orderBy(F.desc("abandonment_rate_pct"), "category_code"))


def fig08_cart_vs_abandoned(abandonment: DataFrame) -> DataFrame:
    return (abandonment.select("category_code", "cart_sessions", "abandoned_sessions")
            .orderBy(F.desc("cart_sessions"), "category_code"))


def fig09_level_distribution(engagement: DataFrame) -> DataFrame:
    lv = F.col("engagement_level")
    counts = engagement.agg(*[F.count_if(lv == level).alias(level) for level in LEVELS])
    return _unpivot(counts, "engagement_level", "customers", [(lv_, F.col(lv_)) for lv_ in LEVELS])


def fig10_top15(engagement: DataFrame, n: int = 15) -> DataFrame:
    """n largest scores (ties: lowest user_id first), shown ascending."""
    top = engagement.orderBy(F.desc("engagement_score"), "user_id").limit(n)
    return top.select("user_id", "engagement_score").orderBy("engagement_score", F.desc("user_id"))


def fig11_avg_value(engagement: DataFrame) -> DataFrame:
    lv = F.col("engagement_level")
    means = engagement.agg(*[
        F.coalesce(F.avg(F.when(lv == level, F.col("purchase_value"))), F.lit(0.0)).alias(level)
        for level in LEVELS])
    return _unpivot(means, "engagement_level", "avg_purchase_value", [(x, F.col(x)) for x in LEVELS])


def fig12_event_types(silver: DataFrame) -> DataFrame:
    t = F.col("event_type")
    counts = silver.agg(*[F.count_if(t == e).alias(e) for e in EVENT_TYPES])
    return _unpivot(counts, "event_type", "events", [(e, F.col(e)) for e in EVENT_TYPES])


def fig13_hourly(silver: DataFrame) -> DataFrame:
    """Hour x type counts (0-filled). Counts non-null sessions, as the chart does."""
    t = F.col("event_type")
    has = F.col("user_session").isNotNull()
    return (silver.groupBy("event_hour")
            .agg(*[F.count_if((t == e) & has).alias(e) for e in EVENT_TYPES])
            .orderBy("event_hour"))


def fig14_daily_revenue(silver: DataFrame) -> DataFrame:
    return (silver.filter(F.col("event_type") == "purchase")
            .groupBy("event_date").agg(F.sum("price").alias("revenue")).orderBy("event_date"))


FIG15_SERIES = ("views", "cart_additions", "purchases", "remove_from_cart_events")


def fig15_event_mix(category: DataFrame) -> DataFrame:
    """Four counts per category plus each bar segment's stacked base."""
    cols = [F.col(c) for c in FIG15_SERIES]
    bases = []
    for i, name in enumerate(FIG15_SERIES):
        base = F.lit(0).cast("bigint")
        for c in cols[:i]:
            base = base + c
        bases.append(base.alias(f"{name}_base"))
    return category.select("category_code", *FIG15_SERIES, *bases)


def fig_scaling(ledger: DataFrame) -> DataFrame:
    """Size, pipeline seconds and (if any present) activity seconds, by size."""
    return (ledger.select("sample_size", "pipeline_seconds", "activity_seconds")
            .orderBy("sample_size"))
