"""Raw feed -> cleaned rows (PRJ-1..7, FN-1..19, FLT-5).

All row work is built-in column expressions inside one projection, so the
whole cleaning step is a single whole-stage-codegen map over the scan: no
shuffle, no Python per row.  Schema decisions (which columns exist, what they
are called) are made once on the driver from ``df.columns``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.functions.numeric import finite, numeric_text
from starlane.functions.text import (
    blank_to_null,
    clean_text,
    first_non_blank,
    map_stripped_payment,
    normalise_header,
    normalise_headers,
    strip,
    strip_quotes,
    title_case,
)
from starlane.functions.time import date_id_of, parse_stamp
from starlane.schema import COLUMN_ALIASES, MEASURE_COLS, REASON_COLS, REQUIRED_COLS, SOURCE_COLS


def with_normalised_headers(df: DataFrame, rule=normalise_header) -> DataFrame:
    """Rename every column by the header rule; collisions raise (PRJ-1/2)."""
    return df.toDF(*normalise_headers(df.columns, rule))


def resolve_aliases(df: DataFrame, aliases: dict[str, list[str]] = COLUMN_ALIASES) -> DataFrame:
    """Map accepted alternative names onto the logical name.

    Only an alternative present: it is renamed.  Both present: the logical
    column becomes the falsy coalesce ``logical or alternative`` (a blank
    logical value falls back to the alternative, JOIN-6) and the alternative
    is dropped.
    """
    out = df
    for logical, alts in aliases.items():
        present = [a for a in alts if a in out.columns]
        if not present:
            continue
        if logical in out.columns:
            out = out.withColumn(logical, first_non_blank(logical, *present)).drop(*present)
        else:
            out = out.withColumnRenamed(present[0], logical)
            if present[1:]:
                out = out.withColumn(logical, first_non_blank(logical, *present[1:])) \
                    .drop(*present[1:])
    return out


def optional_col(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """``row.get(name)``: the column if present, else a typed NULL (PRJ-5)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def clean_id(c: Column) -> Column:
    """Strip white space, then surrounding quote runs, white space again; empty -> NULL."""
    return clean_text(strip_quotes(strip(c)))


def filtered_distinct(cleaned: DataFrame, required: list[str] = REQUIRED_COLS) -> DataFrame:
    """Cleaned rows that have every required value, once each (FLT-4).

    A booking without id, customer or day is dropped, and so is a ride of
    negative distance or fare; equal rows count once."""
    not_negative = [F.coalesce(F.col(c), F.lit(0.0)) >= 0 for c in ("booking_value", "ride_distance")]
    kept = cleaned.na.drop(subset=["date_id" if c == "date" else c for c in required])
    return kept.where(not_negative[0] & not_negative[1]).distinct()


def clean_bookings(raw: DataFrame, header_rule=normalise_header) -> DataFrame:
    """Normalise headers and values of a raw bookings feed.

    Output: the 18 logical source columns (text cleaned, measures as double)
    plus ``booking_timestamp`` (timestamp_ntz), ``booking_date`` and
    ``date_id`` (YYYYMMDD int).  Row count is unchanged.
    """
    df = resolve_aliases(with_normalised_headers(raw, header_rule))
    present = set(df.columns)

    # Each value is bound once before it is used more than once, in projections
    # that the planner does not fold (a value bound in one is used twice in the
    # next).  Two halves go through them a step apart, which keeps every one small.
    with_time = "time" in present
    stamp = F.concat_ws(" ", "date", "time") if with_time else F.col("date")
    ts = parse_stamp(F.col("_stamp"), with_time) if "date" in present else F.lit(None).cast("timestamp_ntz")
    first = ["date", "time", "booking_id", "booking_status", "customer_id", "payment_method", "booking_value",
             "ride_distance", "driver_ratings"]
    second = [c for c in SOURCE_COLS if c not in first]
    bound: dict[str, Column] = {
        "booking_id": strip_quotes("booking_id"),
        "booking_status": title_case("booking_status"),
        "customer_id": strip_quotes("customer_id"),
        "payment_method": map_stripped_payment(F.col("payment_method")),
        **{m: numeric_text(F.col(m)).try_cast("double") for m in MEASURE_COLS},
    }
    final: dict[str, Column] = {
        **{c: strip(c) for c in ("booking_id", "customer_id")},    # white space inside the quotes
        **{m: finite(F.col(m)) for m in MEASURE_COLS},
    }
    named = df.select(*[(F.col(c) if c in present else F.lit(None).cast("string")).alias(c) for c in SOURCE_COLS])
    take = lambda cols, how: [how(c).alias(c) for c in cols]
    as_it_is, bind = F.col, lambda c: bound.get(c, F.col(c))
    finish = lambda c: final.get(c, blank_to_null(c))
    steps = named.select(*take(first, strip), *take(second, as_it_is))
    steps = steps.select(*take(first, bind), stamp.alias("_stamp"), *take(second, strip))
    steps = steps.select(*take(first, finish), ts.alias("booking_timestamp"), *take(second, bind))
    last = lambda c: blank_to_null(c) if c in ("booking_id", "customer_id") else finish(c) if c in second else F.col(c)
    cleaned = steps.select(*take(SOURCE_COLS, last), "booking_timestamp")
    return cleaned.withColumns({
        "booking_date": F.to_date("booking_timestamp"),
        "date_id": date_id_of("booking_timestamp"),
    })
