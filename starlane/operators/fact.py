"""Fact assembly: cleaned rows -> ``fact_booking`` (JOIN-5, PRJ-8).

One output row per cleaned row (no dedup).  Eight lookups against five
dimensions: customer, vehicle, payment, location twice (pickup/drop roles)
and reason three times (customer/driver/incomplete roles).  ``date_id`` is
already the date dimension's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.operators.dimensions import Dimension
from starlane.operators.lookup import lookup
from starlane.schema import FACT_COLS, STAR_SCHEMAS

# (dimension, fact column, foreign key name)
LOOKUPS = [
    ("dim_customer", "customer_id", "customer_sk"),
    ("dim_vehicle", "vehicle_type", "vehicle_sk"),
    ("dim_location", "pickup_location", "pickup_location_sk"),
    ("dim_location", "drop_location", "drop_location_sk"),
    ("dim_payment", "payment_method", "payment_sk"),
    ("dim_reason", "reason_for_cancelling_by_customer", "customer_cancel_reason_sk"),
    ("dim_reason", "driver_cancellation_reason", "driver_cancel_reason_sk"),
    ("dim_reason", "incomplete_rides_reason", "incomplete_reason_sk"),
]


def apply_lookups(cleaned: DataFrame, dims: dict[str, Dimension],
                  lookups=LOOKUPS) -> DataFrame:
    out = cleaned
    for dim_name, col, fk in lookups:
        if dim_name in dims:
            out = lookup(out, dims[dim_name], col, fk)
        else:
            out = out.withColumn(fk, F.lit(None).cast("bigint"))
    return out


def build_fact(cleaned: DataFrame, dims: dict[str, Dimension], columns: list[str] = FACT_COLS) -> DataFrame:
    """Star assembly; output columns and types as ``STAR_SCHEMAS['fact_booking']``.

    ``columns`` keeps some of them (a KPI's), and only the lookups behind
    those are made."""
    needed = [x for x in LOOKUPS if x[2] in columns]
    out = apply_lookups(cleaned, dims, needed)
    types = {f.name: f.dataType for f in STAR_SCHEMAS["fact_booking"].fields}
    return out.select(*[F.col(c).cast(types[c]).alias(c) for c in FACT_COLS if c in columns])
