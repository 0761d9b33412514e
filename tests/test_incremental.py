"""CDC upserts, incremental dimensions and the file-source stream."""

import datetime as dt
import os

from pyspark.sql import functions as F

from starlane.operators.cdc import latest_per_key, upsert_latest
from starlane.operators.cleaning import clean_bookings
from starlane.operators.dimensions import DIMENSION_BUILDERS
from starlane.operators.fact import build_fact
from starlane.sinks.files import write_csv
from starlane.streaming.incremental import (
    IncrementalDims,
    fact_with_natural_keys,
    stream_star,
)
from tests.test_star import ROWS, raw_rows

SCHEMA = "id string, ts timestamp_ntz, v string, day int"


def t(h):
    return dt.datetime(2024, 1, 1, h)


def test_latest_per_key_tie_breaks_on_all_columns(spark):
    df = spark.createDataFrame([("a", t(1), "x", 1), ("a", t(2), "y", 1), ("a", t(2), "z", 1),
                                ("b", None, "q", 2), ("b", t(0), "p", 2), (None, t(5), "n", 3)],
                               SCHEMA)
    got = sorted((tuple(r) for r in latest_per_key(df, "id", ["ts"]).collect()), key=repr)
    assert got == sorted([("a", t(2), "z", 1), ("b", t(0), "p", 2), (None, t(5), "n", 3)], key=repr)


def test_upsert_moves_key_and_is_idempotent(spark, tmp_root):
    target = os.path.join(tmp_root, "zone")
    first = spark.createDataFrame([("a", t(1), "x", 1), ("b", t(1), "y", 1), ("c", t(1), "z", 2)],
                                  SCHEMA)
    upsert_latest(target, first, "id", ["ts"], "day")
    # 'c' moves from day 2 (its only row) to day 3; 'a' is updated in place
    change = spark.createDataFrame([("c", t(2), "z2", 3), ("a", t(3), "x2", 1)], SCHEMA)
    for i in range(2):  # the second application must change nothing
        upsert_latest(target, change, "id", ["ts"], "day")
        got = sorted(tuple(r) for r in spark.read.parquet(target).select("id", "ts", "v", "day")
                     .collect())
        assert got == [("a", t(3), "x2", 1), ("b", t(1), "y", 1), ("c", t(2), "z2", 3)]
    assert not os.path.exists(os.path.join(target, "day=2"))


def test_upsert_replay_keeps_rows_without_key_and_odd_partitions(spark, tmp_root):
    target = os.path.join(tmp_root, "zone")
    schema = "id string, ts timestamp_ntz, v string, day string"
    first = spark.createDataFrame([(None, t(1), "x", "a/b=c"), (None, t(1), "x", "a/b=c"), ("k", t(1), "y", "a/b=c")], schema)
    second = spark.createDataFrame([(None, t(1), "x", "a/b=c"), (None, t(2), "n", "d"), ("k", t(2), "z", "d")], schema)
    upsert_latest(target, first, "id", ["ts"], "day")
    for change in (first, second, first, second, second):
        upsert_latest(target, change, "id", ["ts"], "day")
    got = sorted((tuple(r) for r in spark.read.parquet(target).select("id", "ts", "v", "day").collect()), key=repr)
    # a row without key that is stored already is no news; the two of the first set stay two
    assert got == sorted([(None, t(1), "x", "a/b=c")] * 2 + [(None, t(2), "n", "d"), ("k", t(2), "z", "d")], key=repr)
    # the only row of an odd partition moves away: its folder goes
    only = spark.createDataFrame([("q", t(1), "1", "x:y")], schema)
    moved = spark.createDataFrame([("q", t(2), "2", "d")], schema)
    upsert_latest(target, only, "id", ["ts"], "day")
    upsert_latest(target, moved, "id", ["ts"], "day")
    assert [r.v for r in spark.read.parquet(target).where("id = 'q'").collect()] == ["2"]


def test_a_target_without_marker_is_written_anew(spark, tmp_root):
    from starlane.plans.star import land_if_absent

    target = os.path.join(tmp_root, "half")
    spark.range(3).write.parquet(target)
    os.remove(os.path.join(target, "_SUCCESS"))
    assert land_if_absent(spark.range(5), target) is True
    assert spark.read.parquet(target).count() == 5


def test_incremental_dimension_keeps_keys(spark, tmp_root):
    d = IncrementalDims(tmp_root + "/dims", ["dim_customer", "dim_vehicle"])
    b1 = spark.createDataFrame([("m", "car"), ("k", None)], "customer_id string, vehicle_type string")
    b2 = spark.createDataFrame([("a", "bike"), ("k", "car"), (None, "auto")],
                               "customer_id string, vehicle_type string")
    assert d.update(b1) == {"dim_customer": 2, "dim_vehicle": 1}
    assert d.update(b2) == {"dim_customer": 1, "dim_vehicle": 2}
    assert d.update(b2) == {"dim_customer": 0, "dim_vehicle": 0}  # replayed batch
    dims = d.dimensions(spark)
    assert sorted(tuple(r) for r in dims["dim_customer"].df.collect()) == [(1, "k"), (2, "m"), (3, "a")]
    assert sorted(tuple(r) for r in dims["dim_vehicle"].df.collect()) == \
        [(1, "car"), (2, "auto"), (3, "bike")]


def test_incremental_store_knows_hot_members_and_compacts(spark, tmp_root):
    d = IncrementalDims(tmp_root + "/dims", ["dim_vehicle"])
    for i, n in enumerate((2, 3)):
        d.update(spark.createDataFrame([("car",)] * n + [(f"v{i}",)], "vehicle_type string"), i)
    d.update(spark.createDataFrame([("car",)] * 3, "vehicle_type string"), 1)   # a replay replaces its counts
    dim = d.dimensions(spark)["dim_vehicle"]
    assert {r.vehicle_type: r.freq for r in dim.freq.collect()} == {"car": 5, "v0": 1}
    before = sorted(map(tuple, dim.df.collect()))
    d.compact(spark)
    assert sorted(map(tuple, d.dimensions(spark)["dim_vehicle"].df.collect())) == before == [(1, "car"), (2, "v0"), (3, "v1")]


def test_an_empty_store_gives_typed_empty_tables(spark, tmp_root):
    dims = IncrementalDims(tmp_root + "/none").dimensions(spark)
    assert {n: d.df.count() for n, d in dims.items()} == dict.fromkeys(dims, 0)
    assert fact_with_natural_keys(spark, tmp_root + "/nothing").count() == 0


def test_a_file_without_a_required_column_stops_the_stream(spark, tmp_root):
    import pytest

    landing = os.path.join(tmp_root, "landing")
    write_csv(raw_rows(spark, ROWS).drop("Booking ID"), landing)
    with pytest.raises(Exception, match="booking_id"):
        stream_star(spark, landing, os.path.join(tmp_root, "star"))


def test_columns_are_mapped_by_header_name(spark, tmp_root):
    raw = raw_rows(spark, ROWS)
    landing = os.path.join(tmp_root, "landing")
    swapped = [c for c in raw.columns if c != "Drop Location"]
    swapped.insert(3, "Drop Location")
    write_csv(raw.select(*[f"`{c}`" for c in swapped]), landing, single_file=True)
    root = os.path.join(tmp_root, "star")
    stream_star(spark, landing, root)
    got = {(r.pickup_location, r.drop_location) for r in fact_with_natural_keys(spark, root).collect()}
    assert got == {("Hub", "Hub"), ("Gate 3, East", None), ("Airport", "Hub"), (None, None)}


def test_stream_equals_batch_and_sees_only_new_files(spark, tmp_root):
    raw = raw_rows(spark, ROWS)
    landing = os.path.join(tmp_root, "landing")
    write_csv(raw.where(F.col("Booking ID") != "B4"), landing + "/part1", single_file=True)
    root = os.path.join(tmp_root, "star")
    stream_star(spark, landing + "/*", root)
    write_csv(raw.where(F.col("Booking ID") == "B4"), landing + "/part2", single_file=True)
    stream_star(spark, landing + "/*", root)  # second run: only the new file
    streamed = fact_with_natural_keys(spark, root)
    cleaned = clean_bookings(raw)
    cols = ["booking_id", "customer_id", "vehicle_type", "pickup_location", "drop_location",
            "payment_method", "reason_for_cancelling_by_customer", "driver_cancellation_reason",
            "incomplete_rides_reason", "booking_status", "booking_value", "date_id"]
    key = lambda r: repr(tuple(r))
    assert sorted(streamed.select(*cols).collect(), key=key) == \
        sorted(cleaned.select(*cols).collect(), key=key)
    batches = spark.read.parquet(os.path.join(root, "fact", "fact_booking")) \
        .groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in batches) == [1, 3]
    # the batch build gives the same natural-key content
    dims = {n: b(cleaned) for n, b in DIMENSION_BUILDERS.items()}
    assert build_fact(cleaned, dims).count() == streamed.count()


def test_a_batch_goes_to_the_store_and_not_the_store_to_the_batch(spark, tmp_root, monkeypatch):
    from starlane.streaming import incremental

    store = os.path.join(tmp_root, "store")
    spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (1, "a", "y")], "sk long, value string, dim string") \
        .write.partitionBy("dim").parquet(store)
    batch = os.path.join(tmp_root, "batch")
    spark.createDataFrame([("x", "a"), ("x", "c"), ("y", "b")], "dim string, value string").write.parquet(batch)
    for limit in (500_000, 0):      # by broadcast, and beyond the limit by shuffle
        monkeypatch.setattr(incremental, "BATCH_BROADCAST_ROWS", limit)
        new = incremental.not_stored(spark.read.parquet(batch), spark.read.parquet(store))
        assert sorted(map(tuple, new.select("dim", "value").collect())) == [("x", "c"), ("y", "b")]
        if limit:
            plan = new._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_rebuilt_dimensions_keep_their_keys(spark, tmp_root):
    from starlane.plans.star import Star, add_mapped_dims

    def rebuild(k, rows):
        df = spark.createDataFrame(rows, "customer_id string, vehicle_type string")
        star = add_mapped_dims(Star(f"{tmp_root}/{k}", df), IncrementalDims(f"{tmp_root}/map", ["dim_customer", "dim_vehicle"]))
        return [sorted(map(tuple, star.dims[n].df.collect())) for n in ("dim_customer", "dim_vehicle")], star

    none, star = rebuild(0, [])
    assert none == [[], []] and star.dims["dim_customer"].rows == 0
    assert rebuild(1, [("m", "car"), ("k", None), ("k", "car")])[0] == [[(1, "k"), (2, "m")], [(1, "car")]]
    got, star = rebuild(2, [("a", "bus"), ("m", None), ("z", "bus")])     # k and the car are gone
    assert got == [[(2, "m"), (3, "a"), (4, "z")], [(2, "bus")]]
    d = star.dims["dim_customer"]
    assert d.rows == 3 and d.key_bytes == 3 and {r.customer_id: r.freq for r in d.freq.collect()} == {"a": 1, "m": 1, "z": 1}
    assert rebuild(3, [("k", "car")])[0] == [[(1, "k")], [(1, "car")]]      # back under the old numbers
