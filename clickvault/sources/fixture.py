"""Click-stream view over the driver's ``events`` and ``part`` tables.

The given test data has no shop click-stream, so the nine raw columns are
derived row by row from ``events`` joined with ``part`` (FIXTURES.md §B),
with defects injected on fixed residues of ``event_id``. Every column is
text, as a CSV reader would deliver it. The rules below are fixed values:
the expected numbers in FIXTURES.md depend on them.

Scale: one pass over ``events``. ``part`` is first reduced to the keys that
occur in ``events`` (a handful, combined map-side), so the join side is small
whatever the size of ``part``; it is measured, and broadcast when it fits.
Copies are made with a generator, not a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickvault.plans.materialize import small_side

# Fixed values of the fixture (FIXTURES.md §B).
EXACT_COPY_MOD, EXACT_COPY_REM = 211, 17
UPPER_COPY_MOD, UPPER_COPY_REM = 223, 29
ROW_NUMBER_COPY_STRIDE = 1_000_000_000_000_000  # copies come after all events, whatever their number
BAD_TIME_MOD, BAD_TIME_REM = 83, 5
SPACED_VIEW_MOD = 4
TAB_TYPE_MOD, TAB_TYPE_REM = 103, 21
NO_PRODUCT_MOD, NO_PRODUCT_REM = 89, 7
CATEGORY_ID_BASE, CATEGORY_ID_MOD = 2053013555631882655, 6
NO_CATEGORY_MOD, NO_CATEGORY_REM = 10, 3
NO_BRAND_MOD, NO_BRAND_REM = 7, 2
TEXT_PRICE_MOD, TEXT_PRICE_REM = 101, 9
NAN_PRICE_MOD, NAN_PRICE_REM = 107, 31
NEGATIVE_PRICE_MOD, NEGATIVE_PRICE_REM = 97, 11
NO_SESSION_MOD, NO_SESSION_REM = 79, 13


def _hit(col, mod, rem):
    return (col % F.lit(mod)) == F.lit(rem)


def clickstream(events: DataFrame, part: DataFrame) -> DataFrame:
    """``source_row_number`` + the nine raw text columns."""
    eid = F.col("event_id")
    ev = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    dims = part.select(F.col("p_partkey").alias("k"), "p_type", "p_brand")
    used = dims.join(ev.select("k").distinct(), "k", "left_semi")
    base = ev.join(small_side(used, "fixture-parts")[0], "k")

    copies = F.filter(
        F.array(F.lit(0), F.lit(1), F.lit(2)),
        lambda d: (d == 0)
        | ((d == 1) & _hit(eid, EXACT_COPY_MOD, EXACT_COPY_REM))
        | ((d == 2) & _hit(eid, UPPER_COPY_MOD, UPPER_COPY_REM)),
    )
    rows = base.select("*", F.explode(copies).alias("dup"))

    et = F.col("event_type")
    base_type = (
        F.when(et == "click", F.lit("cart"))
        .when(et == "signup", F.lit("remove_from_cart"))
        .when(et == "view", F.when((eid % SPACED_VIEW_MOD) == 0, F.lit("  View")).otherwise(F.lit("view")))
        .otherwise(et)
    )
    raw_type = (
        F.when(F.col("dup") == 2, F.upper(base_type))
        .when(_hit(eid, TAB_TYPE_MOD, TAB_TYPE_REM), F.concat(base_type, F.lit("\t")))
        .otherwise(base_type)
    )
    value_text = F.col("value").cast("string")
    price = (
        F.when(_hit(eid, TEXT_PRICE_MOD, TEXT_PRICE_REM), F.lit("n/k"))
        .when(_hit(eid, NAN_PRICE_MOD, NAN_PRICE_REM), F.lit("NaN"))
        .when(_hit(eid, NEGATIVE_PRICE_MOD, NEGATIVE_PRICE_REM), F.concat(F.lit("-"), value_text))
        .otherwise(value_text)
    )
    k = F.col("k")
    null_text = F.lit(None).cast("string")
    return rows.select(
        (F.lit(2) + eid + F.lit(ROW_NUMBER_COPY_STRIDE) * F.col("dup")).cast("bigint").alias("source_row_number"),
        F.when(_hit(eid, BAD_TIME_MOD, BAD_TIME_REM), F.lit("not-a-date"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))).alias("event_time"),
        raw_type.alias("event_type"),
        F.when(_hit(eid, NO_PRODUCT_MOD, NO_PRODUCT_REM), null_text).otherwise(k.cast("string")).alias("product_id"),
        (F.lit(CATEGORY_ID_BASE).cast("bigint") + k % CATEGORY_ID_MOD).cast("string").alias("category_id"),
        F.when(_hit(k, NO_CATEGORY_MOD, NO_CATEGORY_REM), null_text).otherwise(F.col("p_type")).alias("category_code"),
        F.when(_hit(k, NO_BRAND_MOD, NO_BRAND_REM), null_text).otherwise(F.col("p_brand")).alias("brand"),
        price.alias("price"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(_hit(eid, NO_SESSION_MOD, NO_SESSION_REM), null_text)
        .otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")))
        .alias("user_session"),
    )
