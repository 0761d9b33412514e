"""Star build on hand-made raw rows: golden values and invariants."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starlane.operators.cleaning import clean_bookings
from starlane.operators.dimensions import (
    DIMENSION_BUILDERS,
    build_dim,
    build_dim_date,
    build_dim_location,
    build_dim_reason,
)
from starlane.operators.fact import build_fact
from starlane.operators.keys import assign_dense_keys
from starlane.operators.lookup import DuplicateKeyError, as_dimension, lookup
from starlane.schema import RAW_HEADERS

BASE = {h: None for h in RAW_HEADERS}


def raw_rows(spark, rows):
    data = [tuple({**BASE, **r}[h] for h in RAW_HEADERS) for r in rows]
    schema = ", ".join(f"`{h}` string" for h in RAW_HEADERS)
    return spark.createDataFrame(data, schema)


ROWS = [
    {"Date": "2024-3-3", "Time": "1:2:3", "Booking ID": '"""B1"""', "Customer ID": '"C1"',
     "Booking Status": " CANCELLED by driver ", "Vehicle Type": " Auto ",
     "Pickup Location": "Hub", "Drop Location": "Hub", "Payment Method": "Upi ",
     "Driver Cancellation Reason": " Driver asked ", "Booking Value": "100.50",
     "Ride Distance": "10", "Driver Ratings": "4.5", "Customer Rating": "null"},
    {"Date": "2024-02-30", "Time": "01:02:03", "Booking ID": "B2", "Customer ID": "C2",
     "Booking Status": "no-show o'neil", "Vehicle Type": "Bike", "Pickup Location": "Gate 3, East",
     "Drop Location": "", "Payment Method": "Wallet",
     "Reason for cancelling by Customer": "Changed mind", "Booking Value": "",
     "Avg VTAT": "NaN", "Ride Distance": "abc"},
    {"Date": "2024-03-03", "Time": "23:59:59", "Booking ID": "B2", "Customer ID": "C1",
     "Booking Status": "completed", "Vehicle Type": "Auto", "Pickup Location": "Airport",
     "Drop Location": "Hub", "Payment Method": " Cash", "Incomplete Rides Reason": "Incomplete: driver ill",
     "Driver Cancellation Reason": "Driver asked", "Booking Value": "50", "Ride Distance": "0"},
    {"Date": None, "Booking ID": "B4", "Customer ID": "", "Vehicle Type": None,
     "Driver Cancellation Reason": "", "Booking Value": " 7.25 "},
]


@pytest.fixture(scope="module")
def cleaned(spark):
    return clean_bookings(raw_rows(spark, ROWS)).cache()


def by_id(df, key="booking_id"):
    return {r[key] + (f"/{r['customer_id']}" if "customer_id" in r else ""): r.asDict()
            for r in df.collect()}


def test_cleaning_golden(cleaned):
    rows = sorted(cleaned.collect(), key=lambda r: (r.booking_id, r.customer_id or ""))
    b1 = rows[0].asDict()
    assert b1["booking_id"] == "B1" and b1["customer_id"] == "C1"
    assert b1["booking_status"] == "Cancelled By Driver"
    assert b1["vehicle_type"] == "Auto" and b1["payment_method"] == "UPI"
    assert str(b1["booking_timestamp"]) == "2024-03-03 01:02:03" and b1["date_id"] == 20240303
    assert b1["driver_cancellation_reason"] == "Driver asked"
    assert b1["booking_value"] == 100.5 and b1["customer_rating"] is None
    bad = [r for r in rows if r.booking_status == "No-Show O'Neil"][0]
    assert bad.booking_timestamp is None and bad.date_id is None
    assert bad.drop_location is None and bad.avg_vtat is None and bad.ride_distance is None
    b4 = [r for r in rows if r.booking_id == "B4"][0]
    assert b4.customer_id is None and b4.driver_cancellation_reason is None
    assert b4.booking_value == 7.25


def test_header_alias_and_missing_columns(spark):
    df = spark.createDataFrame([("2024-01-02", "x", "late")],
                               "`Date` string, `Booking ID` string, `Reason for cancelling` string")
    r = clean_bookings(df).first()
    assert r.reason_for_cancelling_by_customer == "late"
    assert str(r.booking_timestamp) == "2024-01-02 00:00:00"  # no time column: date only
    assert r.customer_id is None and r.avg_vtat is None


def test_dimensions_dense_unique_and_sorted(cleaned):
    for name, builder in DIMENSION_BUILDERS.items():
        d = builder(cleaned, num_partitions=3)
        rows = sorted(d.df.collect(), key=lambda r: r[d.sk])
        assert [r[d.sk] for r in rows] == list(range(1, len(rows) + 1)), name
        nks = [r[d.nk] for r in rows]
        assert nks == sorted(nks) and len(set(nks)) == len(nks) and None not in nks, name
        assert d.rows == len(rows)
    loc = build_dim_location(cleaned)
    assert [r.location_name for r in loc.df.orderBy("location_sk").collect()] == \
        ["Airport", "Gate 3, East", "Hub"]
    reason = {r.reason_text: r.type for r in build_dim_reason(cleaned).df.collect()}
    assert reason == {"Changed mind": "customer_cancellation", "Driver asked": "driver_cancellation",
                      "Incomplete: driver ill": "incomplete"}


def test_dim_date(cleaned):
    rows = build_dim_date(cleaned).collect()
    assert [tuple(r) for r in rows] == [(20240303, __import__("datetime").date(2024, 3, 3), 2024, 3, 1,
                                          "Sunday")]


def test_fact_invariants(cleaned):
    dims = {n: b(cleaned) for n, b in DIMENSION_BUILDERS.items()}
    fact = build_fact(cleaned, dims)
    assert fact.count() == cleaned.count() == 4   # no dedup, repeated id kept
    rows = {(r.booking_id, r.booking_status): r for r in fact.collect()}
    b1 = rows[("B1", "Cancelled By Driver")]
    assert b1.pickup_location_sk == b1.drop_location_sk is not None
    assert b1.driver_cancel_reason_sk is not None and b1.customer_cancel_reason_sk is None
    b4 = rows[("B4", None)]
    assert b4.customer_sk is None and b4.vehicle_sk is None and b4.driver_cancel_reason_sk is None
    b3 = rows[("B2", "Completed")]
    assert b3.driver_cancel_reason_sk == b1.driver_cancel_reason_sk  # padded reason: one member


def test_rerun_gives_equal_tables(cleaned):
    a = build_fact(cleaned, {n: b(cleaned) for n, b in DIMENSION_BUILDERS.items()})
    b = build_fact(cleaned, {n: b(cleaned, num_partitions=2) for n, b in DIMENSION_BUILDERS.items()})
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_distributed_keys_equal_global_row_number(spark):
    rnd = random.Random(7)
    vals = list({"".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 6)))
                 for _ in range(5000)})
    df = spark.createDataFrame([(v,) for v in vals], "nk string")
    keyed = assign_dense_keys(df, "nk", "sk", num_partitions=7)
    want = df.select(F.row_number().over(Window.orderBy("nk")).cast("long").alias("sk"), "nk")
    assert keyed.rows == len(vals)
    assert keyed.df.exceptAll(want).count() == 0 and want.exceptAll(keyed.df).count() == 0


def test_keys_with_offset(spark):
    df = spark.createDataFrame([("b",), ("a",)], "nk string")
    keyed = assign_dense_keys(df, "nk", "sk", offset=10)
    assert sorted(tuple(r) for r in keyed.df.collect()) == [(11, "a"), (12, "b")]


def test_lookup_refuses_duplicate_keys(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "x")], "sk bigint, nk string")
    with pytest.raises(DuplicateKeyError):
        as_dimension(dim, "nk", "sk")


def test_lookup_shuffle_path_equals_broadcast_path(spark):
    fact = spark.createDataFrame([(i, None if i % 3 == 0 else f"k{i % 7}") for i in range(200)],
                                 "id int, v string")
    dim = as_dimension(spark.createDataFrame([(i + 1, f"k{i}") for i in range(5)],
                                             "sk bigint, nk string"), "nk", "sk")
    b = lookup(fact, dim, "v", "v_sk")
    s = lookup(fact, dim, "v", "v_sk", max_bytes=0)
    assert "BroadcastHashJoin" in b._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, b.collect())) == sorted(map(tuple, s.collect()))
    assert s.count() == 200
    got = {r.id: r.v_sk for r in s.collect()}
    assert got[0] is None and got[1] == 2 and got[6] is None  # k6 has no member


def test_dimension_from_several_columns_drops_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "a")], "x string, y string")
    d = build_dim(df, "d", ["x", "y"], "v", "v_sk")
    assert sorted(tuple(r) for r in d.df.collect()) == [(1, "a"), (2, "b")]


def test_alias_falls_back_when_logical_is_blank(spark):
    df = spark.createDataFrame(
        [("x1", "", "late"), ("x2", "rain", "other"), ("x3", None, None)],
        "`Booking ID` string, `Reason for cancelling by Customer` string, "
        "`Reason for cancelling` string")
    got = {r.booking_id: r.reason_for_cancelling_by_customer
           for r in clean_bookings(df).collect()}
    assert got == {"x1": "late", "x2": "rain", "x3": None}


def test_cleaned_schema_is_the_declared_one(cleaned):
    from starlane.schema import CLEANED_SCHEMA

    assert [(f.name, f.dataType) for f in cleaned.schema] == \
        [(f.name, f.dataType) for f in CLEANED_SCHEMA]


def test_build_star_writes_every_zone(spark):
    from starlane.plans.star import build_star, table_path
    from starlane.schema import STAR_SCHEMAS
    from tests.conftest import SF_SMALL

    st = build_star(spark, SF_SMALL)
    n = st.cleaned.count()
    assert n > 0 and st.fact.count() == n
    for name, schema in STAR_SCHEMAS.items():  # one layout, declared columns, each readable by itself
        back = spark.read.parquet(table_path(st, name))
        assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in schema]
        assert back.count() > 0
    members = spark.read.parquet(f"{st.root}/members")
    assert set(members.columns) == {"sk", "value", "type", "freq", "dim"}


def test_one_dimension_has_the_same_layout(spark):
    from starlane.plans import star as S
    from tests.conftest import SF_SMALL

    one = S.add_dims(S.start(spark, SF_SMALL, "one", ["vehicle_type"], zone=False), ["dim_vehicle"])
    assert set(spark.read.parquet(f"{one.root}/members").columns) == {"sk", "value", "type", "freq", "dim"}
    assert one.dims["dim_vehicle"].freq is not None and one.dims["dim_vehicle"].key_bytes > 0


def test_head_is_ordered(spark):
    from starlane.operators.sorts import head

    df = spark.createDataFrame([(3,), (1,), (2,)], "a int")
    assert [r.a for r in head(df, 2, [F.col("a")]).collect()] == [1, 2]


def test_filtered_distinct(spark, cleaned):
    from starlane.operators.cleaning import filtered_distinct

    negative = cleaned.withColumn("booking_value", F.lit(-1.0))
    rows = filtered_distinct(cleaned.union(cleaned).union(negative)).collect()
    assert sorted(r.booking_id for r in rows) == ["B1", "B2"]


def test_reason_sources(spark, cleaned):
    from starlane.operators.dimensions import reason_sources

    got = {r.reason_text: r.source_type for r in reason_sources(cleaned, build_dim_reason(cleaned)).collect()}
    assert got == {"Changed mind": "customer", "Driver asked": "driver", "Incomplete: driver ill": "incomplete"}


def test_masking_needs_a_salt(spark):
    from starlane.operators.masking import mask_ids

    df = spark.createDataFrame([("Ab1",)], "id string")
    with pytest.raises(ValueError, match="salt"):
        mask_ids(df, "id", "")
    r = mask_ids(df, "id", "s").first()
    assert r.id_masked == "Xxn" and len(r.id_hash) == 64


def test_huge_fares_do_not_stop_a_kpi(spark):
    from starlane.operators import kpi
    from starlane.operators.quality import cleaned_counts, daily_anomalies

    rows = [{**r, "Booking Value": "1e20"} for r in ROWS[:1]] + ROWS
    wide = clean_bookings(raw_rows(spark, rows))
    fact = build_fact(wide, {n: b(wide) for n, b in DIMENSION_BUILDERS.items()})
    dims = {n: b(wide) for n, b in DIMENSION_BUILDERS.items()}
    total = kpi.kpi_daily_rides_revenue(fact, dims).collect()
    assert sum(r.rides for r in total) == 5
    assert daily_anomalies(fact).first().revenue == 150.5
    assert wide.agg(cleaned_counts(wide)["overflow_booking_value"]).first()[0] == 1


def test_schema_checks_see_the_raw_headers(spark, cleaned):
    from starlane.operators.quality import dimension_key_row, schema_checks

    assert schema_checks(raw_rows(spark, ROWS), {"cleaned": cleaned}) == {"missing_columns": 0, "wrong_column_types": 0}
    only = spark.createDataFrame([("2024-01-01",)], "`Date` string")
    wrong = cleaned.withColumn("date_id", F.lit("x")).drop("time")
    assert schema_checks(only, {"cleaned": wrong}) == {"missing_columns": 17, "wrong_column_types": 2}
    d = build_dim_location(cleaned)
    d.df = d.df.union(d.df.limit(1))
    assert dimension_key_row({"dim_location": d}).first().asDict() == {
        "duplicate_dim_location_location_name": 1, "duplicate_dim_location_location_sk": 1}
