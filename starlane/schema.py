"""Logical schemas of the bookings flow: raw columns, cleaned columns, star tables.

Fixed values that must equal the source system's for right results are kept
together here, as plain text, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Raw bookings CSV header, as documented for the source feed (21 columns).
RAW_HEADERS = [
    "Date", "Time", "Booking ID", "Booking Status", "Customer ID",
    "Vehicle Type", "Pickup Location", "Drop Location", "Avg VTAT", "Avg CTAT",
    "Cancelled Rides by Customer", "Reason for cancelling by Customer",
    "Cancelled Rides by Driver", "Driver Cancellation Reason",
    "Incomplete Rides", "Incomplete Rides Reason", "Booking Value",
    "Ride Distance", "Driver Ratings", "Customer Rating", "Payment Method",
]
# Payment method value map (lookup on the trimmed text, pass-through otherwise).
PAYMENT_MAP = {"Upi": "UPI", "Debit Card": "Debit Card",
               "Credit Card": "Credit Card", "Cash": "Cash"}
# Reason type by wording: first matching word wins, else the default.
REASON_TYPE_RULES = [("incomplete", "incomplete"), ("driver", "driver_cancellation")]
REASON_TYPE_DEFAULT = "customer_cancellation"
# Accepted alternative names per logical column (by normalised header).
COLUMN_ALIASES = {"reason_for_cancelling_by_customer": ["reason_for_cancelling"]}
# Logical columns of the cleaned zone, by normalised header.
SOURCE_COLS = [
    "date", "time", "booking_id", "booking_status", "customer_id",
    "vehicle_type", "pickup_location", "drop_location", "avg_vtat", "avg_ctat",
    "booking_value", "ride_distance", "driver_ratings", "customer_rating",
    "payment_method", "reason_for_cancelling_by_customer",
    "driver_cancellation_reason", "incomplete_rides_reason",
]
MEASURE_COLS = ["avg_vtat", "avg_ctat", "booking_value", "ride_distance",
                "driver_ratings", "customer_rating"]
REASON_COLS = ["reason_for_cancelling_by_customer", "driver_cancellation_reason",
               "incomplete_rides_reason"]
# Columns of the published star tables.
STAR_COLUMNS = {
    "dim_date": "date_id int, date date, year int, month int, quarter int, day_of_week string",
    "dim_customer": "customer_sk bigint, customer_id string",
    "dim_vehicle": "vehicle_sk bigint, vehicle_type string",
    "dim_location": "location_sk bigint, location_name string",
    "dim_payment": "payment_sk bigint, payment_method string",
    "dim_reason": "reason_sk bigint, reason_text string, type string",
    "fact_booking": (
        "booking_id string, date_id int, customer_sk bigint, vehicle_sk bigint, "
        "pickup_location_sk bigint, drop_location_sk bigint, payment_sk bigint, "
        "customer_cancel_reason_sk bigint, driver_cancel_reason_sk bigint, "
        "incomplete_reason_sk bigint, booking_status string, avg_vtat double, "
        "avg_ctat double, booking_value double, ride_distance double, "
        "driver_ratings double, customer_rating double"),
}
# --- end of fixed values ----------------------------------------------------

CLEANED_COLS = SOURCE_COLS + ["booking_timestamp", "booking_date", "date_id"]


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
          "double": T.DoubleType(), "date": T.DateType(),
          "timestamp_ntz": T.TimestampNTZType(), "boolean": T.BooleanType()}


def _struct(spec: str) -> T.StructType:
    """``"a string, b int"`` -> StructType (simple types only; no session needed)."""
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


CLEANED_SCHEMA = _struct(
    "date string, time string, booking_id string, booking_status string, "
    "customer_id string, vehicle_type string, pickup_location string, "
    "drop_location string, avg_vtat double, avg_ctat double, "
    "booking_value double, ride_distance double, driver_ratings double, "
    "customer_rating double, payment_method string, "
    "reason_for_cancelling_by_customer string, driver_cancellation_reason string, "
    "incomplete_rides_reason string, booking_timestamp timestamp_ntz, "
    "booking_date date, date_id int")

STAR_SCHEMAS = {name: _struct(spec) for name, spec in STAR_COLUMNS.items()}
FACT_COLS = STAR_SCHEMAS["fact_booking"].fieldNames()
# Columns a feed must carry (after header normalisation and aliases).
REQUIRED_COLS = ["date", "booking_id", "customer_id"]
