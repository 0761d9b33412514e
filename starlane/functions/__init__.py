"""Column functions: pure ``Column -> Column`` builders on built-in Spark SQL
expressions (no Python UDFs), plus driver-side helpers that act on schema
names only."""

from starlane.functions.numeric import safe_double, safe_int
from starlane.functions.text import (
    blank_to_null,
    clean_text,
    map_payment,
    normalise_header,
    normalise_headers,
    reason_type,
    strip,
    strip_quotes,
    title_case,
)
from starlane.functions.time import calendar_columns, date_id_of, parse_booking_ts, parse_formats

__all__ = [
    "blank_to_null", "calendar_columns", "clean_text", "date_id_of", "map_payment",
    "normalise_header", "normalise_headers", "parse_booking_ts", "parse_formats",
    "reason_type", "safe_double", "safe_int", "strip", "strip_quotes", "title_case",
]
