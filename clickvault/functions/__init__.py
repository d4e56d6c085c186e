from clickvault.functions.columns import (
    event_type_is_valid,
    format_g,
    format_g_sql,
    is_invalid_price,
    normalise_event_type,
    parse_event_time,
    parse_price,
    safe_rate,
    safe_rate_sql,
    shift_id,
    to_id,
)

__all__ = [
    "event_type_is_valid",
    "format_g",
    "format_g_sql",
    "is_invalid_price",
    "normalise_event_type",
    "parse_event_time",
    "parse_price",
    "safe_rate",
    "safe_rate_sql",
    "shift_id",
    "to_id",
]
