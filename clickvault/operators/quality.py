"""Audited cleaning: bronze rows -> one tagged frame -> Silver / report / rejects.

``tag`` adds a single ``rejection_reason`` column (null = clean). Reasons are
tested in a fixed order and the first match wins, so every dropped row has
exactly one reason and ``raw = clean + sum(reasons)`` always holds.

Duplicates ("keep the first copy in file order") are found without a window
over the row key: a window sends every copy of a key to one task, and a
group of copies may hold a large share of all rows. See ``repeated_keys``:
a narrow fingerprint aggregate finds the few repeated keys, the exact
first row is computed over those candidates only, and the result is
joined back to the rows — broadcast when its measured size allows, so the
rows themselves are never shuffled. Beyond that a bitmap of the repeated
fingerprints (at most ``FLAG_BITS``) parts the rows: those whose bits are not
set pass straight through, the others are written once and compared exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickvault.functions.columns import (
    event_type_is_valid,
    event_type_is_valid_sql,
    is_invalid_price,
    is_invalid_price_sql,
    normalise_event_type,
    parse_event_time,
    parse_price,
    to_id,
    to_id_sql,
)
from clickvault.plans.materialize import materialize, measured_side, small_side
from clickvault.schemas import DEFAULT_TIME_FORMAT, RAW_COLUMNS, REASONS, REPORT_REASON_ORDER

ROW = "source_row_number"
REASON = "rejection_reason"
DEDUPE_MODES = ("raw", "normalised")
# columns compared by the "normalised" rule: parsed time/type/price + six raw columns
_NORMALISED_KEYS = ("_t", "_et", "_p", "product_id", "category_id", "category_code",
                    "brand", "user_id", "user_session")


def _fingerprint(df: DataFrame, keys) -> tuple[Column, Column]:
    """96-bit fingerprint of a key (xxhash64 + murmur3). Collisions only add
    candidates; the exact comparison below removes them. Floating keys get
    ``+ 0.0`` so -0.0 hashes like 0.0 (they compare equal in the exact step;
    NaN bit patterns are already canonical in the hash)."""
    types = dict(df.dtypes)
    cols = [F.col(k) + F.lit(0.0) if types.get(k) in ("double", "float") else F.col(k) for k in keys]
    return F.xxhash64(*cols), F.hash(*cols)


def repeated_fingerprints(df: DataFrame, keys) -> tuple[DataFrame, int, bool]:
    """Fingerprints seen twice or more (narrow rows, map-side combined, so a
    hot key ships one row per task); measured, broadcast-hinted when they
    fit. Needs only the key columns (no row order)."""
    h1, h2 = _fingerprint(df, keys)
    hot = (df.select(h1.alias("_h1"), h2.alias("_h2"))
           .groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") > 1).select("_h1", "_h2"))
    return measured_side(hot, "dup-fingerprints")


def _first_rows(candidates: DataFrame, keys, order_col: str) -> DataFrame:
    """Exact keys seen more than once, with the first ``order_col`` of each."""
    return (candidates.groupBy(*keys)
            .agg(F.min(order_col).alias("_first_row"), F.count(F.lit(1)).alias("_copies"))
            .filter(F.col("_copies") > 1).drop("_copies"))


def repeated_keys(df: DataFrame, keys, order_col: str = ROW,
                  fingerprints: tuple[DataFrame, int, bool] | None = None) -> DataFrame | None:
    """Exact keys seen more than once, with the first ``order_col`` of each;
    ``None`` when no key repeats.

    1. fingerprints seen twice or more (``repeated_fingerprints``, or the
       result of an earlier call on the same rows);
    2. group only the candidate rows (joined to those fingerprints) by the
       exact key.
    """
    hot, n_hot, _ = fingerprints if fingerprints is not None else repeated_fingerprints(df, keys)
    if n_hot == 0:
        return None
    h1, h2 = _fingerprint(df, keys)
    candidates = (df.select(*keys, order_col, h1.alias("_h1"), h2.alias("_h2"))
                  .join(hot, ["_h1", "_h2"], "left_semi"))
    return _first_rows(candidates, keys, order_col)


def _with_flag(df: DataFrame, firsts: DataFrame, keys, order_col: str, flag: str) -> DataFrame:
    left, right = df.alias("_l"), firsts.alias("_r")
    cond = reduce(lambda a, b: a & b,
                  [F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys])
    is_dup = F.col("_r._first_row").isNotNull() & (F.col(f"_l.{order_col}") > F.col("_r._first_row"))
    return left.join(right, cond, "left").select("_l.*", is_dup.alias(flag))


FLAG_BITS = 1 << 25  # most bits of the bitmap of repeated fingerprints (4 MB)


def fingerprint_bits(hot: DataFrame, n_hot: int) -> tuple[DataFrame, int]:
    """One row ``bits``: a bitmap (array of 64-bit words) with two bits of each
    fingerprint set, and its size in bits. About 1 % of other fingerprints have
    both bits set at 16 bits a fingerprint, more beyond ``FLAG_BITS``; none of
    ``hot`` is ever missed."""
    size = min(FLAG_BITS, max(64, 1 << (16 * n_hot - 1).bit_length()))
    at = hot.select(F.explode(F.array(*_bit_places(F.col("_h1"), size))).alias("_at"))
    words = at.select(F.expr("_at div 64").alias("_word"), F.expr("shiftleft(1L, CAST(_at % 64 AS INT))").alias("_set"))
    every = hot.sparkSession.range(size // 64).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_set"))
    dense = words.unionAll(every).groupBy("_word").agg(F.bit_or("_set").alias("_set"))
    row = dense.agg(F.sort_array(F.collect_list(F.struct("_word", "_set"))).alias("_all"))
    return materialize(row.select(F.col("_all._set").alias("bits")), "dup-bits"), size


def _bit_places(h: Column, size: int) -> tuple[Column, Column]:
    """Two places below ``size`` from the two halves of a 64-bit hash."""
    return h.bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(size - 1))


def _may_repeat(h: Column, bits: DataFrame, size: int) -> Column:
    words = bits.scalar()
    hits = [F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1 for p in _bit_places(h, size)]
    return hits[0] & hits[1]


def mark_duplicates(df: DataFrame, keys: list[str] | tuple[str, ...], order_col: str = ROW,
                    flag: str = "_is_duplicate",
                    fingerprints: tuple[DataFrame, int, bool] | None = None) -> DataFrame:
    """Add ``flag``: true for every row but the first (by ``order_col``) of its key.

    Nulls compare equal, as in pandas ``duplicated``. Runs one or two small
    jobs eagerly (fingerprints; candidates only when some fingerprint
    repeats); the returned frame is lazy and, when the repeated keys fit a
    broadcast, has no shuffle of the rows at all. When they do not, only the
    rows that may repeat (``fingerprint_bits``) are written and shuffled.
    """
    hot, n_hot, fits = fingerprints if fingerprints is not None else repeated_fingerprints(df, keys)
    if n_hot == 0:
        return df.select("*", F.lit(False).alias(flag))
    if fits:
        firsts, _ = small_side(repeated_keys(df, keys, order_col, (hot, n_hot, fits)), "dup-firsts")
        return _with_flag(df, firsts, keys, order_col, flag)
    bits, size = fingerprint_bits(hot, n_hot)
    may = _may_repeat(_fingerprint(df, keys)[0], bits, size)
    single = df.filter(~may).select("*", F.lit(False).alias(flag))
    several = materialize(df.filter(may), "dup-several")
    return single.unionByName(_with_flag(several, _first_rows(several, keys, order_col), keys, order_col, flag))


def with_parsed(raw: DataFrame, time_format: str | None = DEFAULT_TIME_FORMAT) -> DataFrame:
    """Add the parsed helper columns ``_t`` (time), ``_et`` (type), ``_p`` (price)."""
    return raw.select(
        "*",
        parse_event_time("event_time", time_format).alias("_t"),
        normalise_event_type("event_type").alias("_et"),
        parse_price("price").alias("_p"),
    )


def reason_sql(is_duplicate: str = "_is_duplicate") -> str:
    """First-match reason chain over the parsed helper columns (SQL text)."""
    missing_id = (f"{to_id_sql('product_id')} IS NULL OR {to_id_sql('user_id')} IS NULL "
                  "OR user_session IS NULL")
    return (
        f"CASE WHEN {is_duplicate} THEN '{REASONS[0]}' "
        f"WHEN _t IS NULL THEN '{REASONS[1]}' "
        f"WHEN NOT {event_type_is_valid_sql('_et')} THEN '{REASONS[2]}' "
        f"WHEN {missing_id} THEN '{REASONS[3]}' "
        f"WHEN {is_invalid_price_sql('_p')} THEN '{REASONS[4]}' "
        f"WHEN _p <= 0 THEN '{REASONS[5]}' END"
    )


def reason_expr(is_duplicate: str = "_is_duplicate") -> Column:
    return F.expr(reason_sql(is_duplicate))


def dedupe_keys(dedupe: str = "raw") -> tuple[str, ...]:
    if dedupe not in DEDUPE_MODES:
        raise ValueError(f"dedupe must be one of {DEDUPE_MODES}, got {dedupe!r}")
    return RAW_COLUMNS if dedupe == "raw" else _NORMALISED_KEYS


def tag(raw: DataFrame, dedupe: str = "raw", time_format: str | None = DEFAULT_TIME_FORMAT,
        order_col: str = ROW, fingerprints: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Raw rows + helpers + ``rejection_reason``.

    ``dedupe="raw"``: copies are equal raw text (before normalising);
    ``dedupe="normalised"``: equal after parsing time, type and price.
    ``fingerprints``: ``repeated_fingerprints`` of the same rows (with the
    parsed helpers), when computed beforehand.
    """
    if dedupe not in DEDUPE_MODES:
        raise ValueError(f"dedupe must be one of {DEDUPE_MODES}, got {dedupe!r}")
    missing = [c for c in (*RAW_COLUMNS, order_col) if c not in raw.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    parsed = with_parsed(raw, time_format)
    flagged = mark_duplicates(parsed, dedupe_keys(dedupe), order_col, fingerprints=fingerprints)
    return flagged.selectExpr("*", f"{reason_sql()} AS {REASON}").drop("_is_duplicate")


def silver(tagged: DataFrame) -> DataFrame:
    """Clean rows, typed, with the four derived time columns (UTC)."""
    t = F.col("_t")
    return tagged.filter(F.col(REASON).isNull()).select(
        t.alias("event_time"),
        F.col("_et").alias("event_type"),
        to_id("product_id").alias("product_id"),
        to_id("category_id").alias("category_id"),
        F.coalesce(F.col("category_code"), F.lit("unknown")).alias("category_code"),
        F.coalesce(F.col("brand"), F.lit("unknown")).alias("brand"),
        F.col("_p").alias("price"),
        to_id("user_id").alias("user_id"),
        F.col("user_session"),
        F.to_date(t).alias("event_date"),
        F.hour(t).alias("event_hour"),
        F.date_format(t, "EEEE").alias("event_day"),
        F.date_format(t, "yyyy-MM").alias("event_month"),
    )


def silver_events(raw: DataFrame, dedupe: str = "raw",
                  time_format: str | None = DEFAULT_TIME_FORMAT) -> DataFrame:
    """The whole cleaning composed (the reference's ``clean``)."""
    return silver(tag(raw, dedupe=dedupe, time_format=time_format))


def quality_report(tagged: DataFrame) -> DataFrame:
    """``(metric, value)``: raw rows, six removal counts, clean rows, removed rows.

    One aggregate over the tagged frame (count_if per reason), then a
    9-row ``stack``; nothing leaves the executors but the final 9 rows.
    """
    counts = tagged.agg(
        F.expr("count(1) AS raw_rows"),
        *[F.expr(f"count_if({REASON} = '{r}') AS {r}") for r in REASONS],
        F.expr(f"count_if({REASON} IS NULL) AS clean_rows"),
    )
    rows = [("raw_rows", "raw_rows")] + list(REPORT_REASON_ORDER)
    rows += [("clean_rows", "clean_rows"), ("removed_rows", "raw_rows - clean_rows")]
    args = ", ".join(f"'{m}', CAST({v} AS BIGINT)" for m, v in rows)
    return counts.selectExpr(f"stack({len(rows)}, {args}) AS (metric, value)")


def rejected_records(tagged: DataFrame, order_col: str = ROW) -> DataFrame:
    """Rejected rows: row number, the nine raw (un-normalised) values, reason."""
    return tagged.filter(F.col(REASON).isNotNull()).select(order_col, *RAW_COLUMNS, REASON)


def reject_preview(tagged: DataFrame, n: int = 20, order_col: str = ROW) -> DataFrame:
    """First ``n`` rejects in row order, five columns, plus how many more exist.

    A top-n report: the limit is the feature. ``additional_rejected_rows`` is
    a scalar subquery (one number), not a join.
    """
    rej = tagged.filter(F.col(REASON).isNotNull())
    more = rej.agg(F.greatest(F.count(F.lit(1)) - F.lit(n), F.lit(0)).cast("bigint")).scalar()
    return (rej.orderBy(order_col).limit(n)
            .select(order_col, "event_type", "price", "user_session", REASON,
                    more.alias("additional_rejected_rows")))


def filter_chain(raw: DataFrame, time_format: str | None = DEFAULT_TIME_FORMAT) -> DataFrame:
    """The reference's un-audited cleaning for timing runs: normalise, distinct
    over normalised rows, then the four filters. Same rows as ``silver`` with
    ``dedupe="normalised"``; no reasons are kept."""
    cols = [c for c in RAW_COLUMNS if c not in ("event_time", "event_type", "price")]
    norm = raw.select(
        parse_event_time("event_time", time_format).alias("event_time"),
        normalise_event_type("event_type").alias("event_type"),
        parse_price("price").alias("price"),
        *cols,
    ).dropDuplicates()
    return norm.filter(
        F.col("event_time").isNotNull()
        & event_type_is_valid(F.col("event_type"))
        & to_id("product_id").isNotNull() & to_id("user_id").isNotNull()
        & F.col("user_session").isNotNull()
        & ~is_invalid_price(F.col("price")) & (F.col("price") > 0)
    )
