"""Column expressions shared by the operators. All JVM-side, no UDFs.

Each rule is written once as Spark SQL text (``*_sql``) over a column
reference; the ``Column`` form parses that text in one call (building the
same tree node by node from Python costs one round trip per node). Passing a
``Column`` instead of a name uses the equivalent ``Column`` API form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickvault.schemas import DEFAULT_TIME_FORMAT, EVENT_TYPES

# Characters Python's str.strip() removes that occur in CSV text fields:
# space, tab, newline, carriage return, vertical tab, form feed.
BLANKS = " \t\n\r\x0b\x0c"


def sql_string(text: str) -> str:
    """A Spark SQL string literal (backslash escapes; control characters as \\uXXXX)."""
    out = []
    for ch in text:
        if ch in ("\\", "'"):
            out.append("\\" + ch)
        elif ord(ch) < 32:
            out.append(f"\\u{ord(ch):04x}")
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def ref(name: str) -> str:
    return f"`{name}`"


# ------------------------------------------------------------ SQL text forms
def parse_event_time_sql(c: str, fmt: str | None = DEFAULT_TIME_FORMAT) -> str:
    return f"try_to_timestamp({c})" if fmt is None else f"try_to_timestamp({c}, {sql_string(fmt)})"


def normalise_event_type_sql(c: str) -> str:
    return f"lower(btrim({c}, {sql_string(BLANKS)}))"


def event_type_is_valid_sql(normalised: str) -> str:
    types = ", ".join(sql_string(t) for t in EVENT_TYPES)
    return f"coalesce({normalised} IN ({types}), false)"


# Decimal spellings of numbers; a JVM cast alone also takes 3.5f, 1d and 0x1p3.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
# Whole numbers, also as a float column spells them (5201.0).
WHOLE = r"^\s*([+-]?\d+)(\.0*)?\s*$"


def parse_price_sql(c: str) -> str:
    return f"CASE WHEN {c} RLIKE {sql_string(NUMBER)} THEN try_cast({c} AS DOUBLE) END"


def is_invalid_price_sql(p: str) -> str:
    return f"({p} IS NULL OR isnan({p}))"


def to_id_sql(c: str) -> str:
    # the fraction is cut as text, so ids beyond 2^53 stay exact
    return f"try_cast(nullif(regexp_extract({c}, {sql_string(WHOLE)}, 1), '') AS BIGINT)"


def safe_rate_sql(num: str, den: str) -> str:
    """SQL text of ``safe_rate`` (for ``selectExpr``/``stack`` projections)."""
    return f"CASE WHEN ({den}) > 0 THEN ({num}) / ({den}) * 100.0 ELSE 0.0 END"


def format_g_sql(col_sql: str) -> str:
    """SQL text of ``format_g``."""
    s = f"format_string('%.6g', CAST({col_sql} AS DOUBLE))"
    s = f"regexp_replace({s}, '(\\\\.\\\\d*?)0+(e|$)', '$1$2')"
    return f"regexp_replace({s}, '\\\\.(e|$)', '$1')"


# ----------------------------------------------------------- Column forms
def parse_event_time(c: str | Column, fmt: str | None = DEFAULT_TIME_FORMAT) -> Column:
    """Text -> UTC instant, null when it does not parse (needs session zone UTC).

    ``fmt=None`` accepts any spelling Spark's free-form parser accepts.
    """
    if isinstance(c, str):
        return F.expr(parse_event_time_sql(ref(c), fmt))
    return F.try_to_timestamp(c) if fmt is None else F.try_to_timestamp(c, F.lit(fmt))


def normalise_event_type(c: str | Column) -> Column:
    """lower + strip of surrounding blanks (not only spaces)."""
    if isinstance(c, str):
        return F.expr(normalise_event_type_sql(ref(c)))
    return F.lower(F.btrim(c, F.lit(BLANKS)))


def event_type_is_valid(normalised: str | Column) -> Column:
    """True only for the four supported types; null input is not valid."""
    if isinstance(normalised, str):
        return F.expr(event_type_is_valid_sql(ref(normalised)))
    return F.coalesce(normalised.isin(*EVENT_TYPES), F.lit(False))


def parse_price(c: str | Column) -> Column:
    """Text -> double, null when it is not a decimal number."""
    if isinstance(c, str):
        return F.expr(parse_price_sql(ref(c)))
    text = c.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def is_invalid_price(p: str | Column) -> Column:
    """Missing or NaN (Spark orders NaN above every number, so test it apart)."""
    if isinstance(p, str):
        return F.expr(is_invalid_price_sql(ref(p)))
    return p.isNull() | F.isnan(p)


def to_id(c: str | Column) -> Column:
    """Identifier text -> bigint, exactly (``5201.0`` is 5201); other text becomes null."""
    if isinstance(c, str):
        return F.expr(to_id_sql(ref(c)))
    return F.nullif(F.regexp_extract(c, WHOLE, 1), F.lit("")).try_cast("bigint")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in seconds, with fractions; null when either is."""
    micros = [F.unix_micros(F.col(c) if isinstance(c, str) else c) for c in (start, end)]
    return (micros[1] - micros[0]) / F.lit(1e6)


def iso_text(c: str | Column) -> Column:
    """ISO 8601 text of an instant, to the second, with the session's offset
    (``2019-10-01T10:00:00+00:00``; sessions run in UTC)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd'T'HH:mm:ssxxx")


def safe_rate(num: Column, den: Column) -> Column:
    """num / den * 100, or 0.0 when den is not positive (never null, never throws)."""
    return F.when(den > 0, num / den * F.lit(100.0)).otherwise(F.lit(0.0))


def shift_id(c: str | Column, block: Column, scale: int) -> Column:
    """Numeric identifier shifted by ``block * scale``; null and non-numeric stay null."""
    return to_id(c) + block.cast("bigint") * F.lit(scale).cast("bigint")


def format_g(c: Column) -> Column:
    """Python's ``format(x, 'g')``: 6 significant digits, no trailing zeros.

    Java's ``%g`` keeps trailing zeros, so they are stripped afterwards from
    the mantissa (``100.620`` -> ``100.62``, ``1.00000e+06`` -> ``1e+06``).
    """
    s = F.format_string("%.6g", c.cast("double"))
    s = F.regexp_replace(s, r"(\.\d*?)0+(e|$)", "$1$2")
    return F.regexp_replace(s, r"\.(e|$)", "$1")
