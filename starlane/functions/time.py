"""Timestamp parsing and calendar attributes (FN-1..7, FN-19)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlane.functions.text import strip


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Valid dates and times but for Feb 29 of common years: a cast that fails throws
# inside and costs as much as many that do not, so most are known by the text.
_ISO_DATE = (r"\d{4}-(?:(?:0?[13578]|1[02])-(?:0?[1-9]|[12]\d|3[01])|(?:0?[469]|11)-(?:0?[1-9]|[12]\d|30)"
             r"|0?2-(?:0?[1-9]|[12]\d))")
_ISO_TIME = r"(?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d"

# Date shapes a feed may use: pattern, and how its groups make year-month-day.
DATE_FORMATS = {
    "yyyy-M-d": (r"(\d{4})-(\d{1,2})-(\d{1,2})", "$1-$2-$3"),
    "yyyy/M/d": (r"(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
    "d-M-yyyy": (r"(\d{1,2})-(\d{1,2})-(\d{4})", "$3-$2-$1"),
    "d/M/yyyy": (r"(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1"),
    "M/d/yyyy": (r"(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"),
    "yyyyMMdd": (r"(\d{4})(\d{2})(\d{2})", "$1-$2-$3"),
}


def _parse(text: Column, with_time: bool) -> Column:
    """Wall-clock timestamp of a ``yyyy-M-d[ H:m:s]`` text, else NULL.

    The shape check keeps the cast from accepting other forms; the cast to
    timestamp_ntz checks the fields (Feb 30, hour 24, ...) and does not depend
    on the session time zone.  The text appears twice and nothing is split,
    so a filter pushed below the projection copies little.
    """
    shape = f"{_ISO_DATE} {_ISO_TIME}" if with_time else _ISO_DATE
    return F.when(text.rlike(f"^{shape}$"), text).try_cast("timestamp_ntz")


def parse_stamp(text: Column, with_time: bool) -> Column:
    """Timestamp of a stripped ``yyyy-M-d[ H:m:s]`` text, else NULL."""
    return _parse(text, with_time)


def parse_booking_ts(date_col: Column | str, time_col: Column | str | None) -> Column:
    """Lenient ``date + ' ' + time`` parse (one-letter fields also take
    unpadded values), NULL on failure.

    Which form is parsed depends on whether a time column *exists* (a schema
    fact decided on the driver), not on the value: a row with a NULL time in a
    feed that has a time column yields NULL, as it would in the source job.
    """
    return parse_formats(date_col, time_col, ["yyyy-M-d"])


def parse_formats(date_col: Column | str, time_col: Column | str | None, formats: list[str]) -> Column:
    """As ``parse_booking_ts``, with a list of date formats tried in order
    (FN-3); the first that gives a valid timestamp wins."""
    date = strip(date_col)
    tried = []
    for name in formats:
        shape, iso = DATE_FORMATS[name]
        text = date if name == "yyyy-M-d" else F.regexp_replace(date, f"^{shape}$", iso)
        own = date.rlike(f"^{shape}$")
        if time_col is None:
            stamp = _parse(text, False)
        else:
            stamp = _parse(F.concat_ws(" ", text, strip(time_col)), True)
        tried.append(stamp if name == "yyyy-M-d" else F.when(own, stamp))
    return F.coalesce(*tried) if len(tried) > 1 else tried[0]


def date_id_of(ts: Column | str) -> Column:
    """YYYYMMDD as int, by arithmetic (no string formatting per row)."""
    t = _c(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def calendar_columns(date_col: Column | str) -> dict[str, Column]:
    d = _c(date_col)
    return {
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "day_of_week": F.date_format(d, "EEEE"),
    }
