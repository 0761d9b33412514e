"""Upserts, deletes, the log of prepared merges, and KPIs kept from differences."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from starlane.operators import cdc, kpi_state
from starlane.operators.cdc import apply_changes, expire_tombstones, latest_per_key, live_rows, upsert_latest

EVENTS = "id string, ts timestamp_ntz, v string, month int, op string"


def t(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def live(spark, zone):
    return sorted((tuple(r) for r in live_rows(spark, zone).select("id", "ts", "v", "month").collect()), key=repr)


def test_change_sets_with_deletes_in_any_order(spark, tmp_root):
    sets = [
        [("a", t(1), "a1", 1, "U"), ("b", t(1), "b1", 1, "U"), (None, t(1), "n", 1, "U"), ("d", t(9), None, 3, "D")],
        [("a", t(5), None, 2, "D"), ("b", t(3), None, 2, "D"), ("c", t(2), None, 1, "d")],
        [("a", t(4), "late", 1, "U"), ("b", t(6), "back", 4, "U"), ("c", t(2), "same time", 1, "U"), ("d", t(8), "d", 1, "U"),
         (None, t(3), None, 1, "D")],
    ]
    want = sorted([("b", t(6), "back", 4), (None, t(1), "n", 1)], key=repr)
    for i, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 2, 0)]):
        zone = os.path.join(tmp_root, f"zone{i}")
        for k in (*order, order[0]):    # the first one arrives again at the end
            apply_changes(zone, spark.createDataFrame(sets[k], EVENTS), "id", ["ts"], "month")
        assert live(spark, zone) == want
        dead = cdc.tombstones(spark, zone).select("id", "ts").collect()
        assert {tuple(r) for r in dead} == {("a", t(5)), ("c", t(2)), ("d", t(9))}


def test_expired_tombstones_go_and_young_ones_stay(spark, tmp_root):
    zone = os.path.join(tmp_root, "zone")
    rows = [("a", t(1), None, 1, "D"), ("b", t(2), None, 1, "D"), ("c", t(1), None, 2, "D"), ("x", t(0), "x", 1, "U")]
    apply_changes(zone, spark.createDataFrame(rows, EVENTS), "id", ["ts"], "month")
    expire_tombstones(spark, zone, t(2), "ts", "month")
    assert [r.id for r in cdc.tombstones(spark, zone).collect()] == ["b"]
    assert live(spark, zone) == [("x", t(0), "x", 1)]


def test_an_unmarked_target_raises_and_keeps_its_files(spark, tmp_root):
    target = os.path.join(tmp_root, "zone")
    rows = spark.createDataFrame([("a", t(1), "x", 1)], "id string, ts timestamp_ntz, v string, month int")
    rows.write.partitionBy("month").parquet(target)
    os.remove(os.path.join(target, "_SUCCESS"))
    before = sorted(glob.glob(target + "/**", recursive=True))
    with pytest.raises(ValueError, match="commit marker"):
        upsert_latest(target, rows, "id", ["ts"], "month")
    assert sorted(glob.glob(target + "/**", recursive=True)) == before
    # a folder that a broken first write left empty is no data
    os.makedirs(os.path.join(tmp_root, "empty", "_temporary", "0"))
    upsert_latest(os.path.join(tmp_root, "empty"), rows, "id", ["ts"], "month")
    assert spark.read.parquet(os.path.join(tmp_root, "empty")).count() == 1


def test_untouched_partitions_keep_their_files(spark, tmp_root):
    zone = os.path.join(tmp_root, "zone")
    schema = "id string, ts timestamp_ntz, v string, month int"
    upsert_latest(zone, spark.createDataFrame([(f"k{i}", t(1), "x", i % 3) for i in range(9)], schema), "id", ["ts"], "month")
    files = lambda m: sorted(os.listdir(f"{zone}/month={m}"))
    before = {m: files(m) for m in range(3)}
    upsert_latest(zone, spark.createDataFrame([("k0", t(2), "y", 0), ("k1", t(0), "older", 2)], schema), "id", ["ts"], "month")
    assert files(1) == before[1] and files(2) == before[2] and files(0) != before[0]
    assert spark.read.parquet(zone).where("id = 'k0'").first().v == "y"


@pytest.mark.parametrize("broken_at", ["before the swap", "before the emptied folders go"])
def test_a_broken_merge_is_put_through_by_the_next(spark, tmp_root, monkeypatch, broken_at):
    zone = os.path.join(tmp_root, "zone")
    first = [("a", t(1), "x", 1, "U"), ("b", t(1), "y", 2, "U")]
    second = [("b", t(2), "moved", 3, "U"), ("a", t(2), None, 1, "D")]
    apply_changes(zone, spark.createDataFrame(first, EVENTS), "id", ["ts"], "month", log_changes=True)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(cdc, "_put_through" if broken_at == "before the swap" else "_partition_dir", stop)
        with pytest.raises(RuntimeError, match="lost"):
            apply_changes(zone, spark.createDataFrame(second, EVENTS), "id", ["ts"], "month", log_changes=True)
    # the same set again: the prepared merge goes through first, and then nothing is new
    apply_changes(zone, spark.createDataFrame(second, EVENTS), "id", ["ts"], "month", log_changes=True)
    assert live(spark, zone) == [("b", t(2), "moved", 3)]
    moves = cdc.differences(spark, zone, 1)
    assert sorted((r.id, r.change_sign, r.deleted) for r in moves.collect()) == \
        [("a", -1, False), ("a", 1, True), ("b", -1, False), ("b", 1, False)]
    assert cdc.versions(spark, zone) == [1, 2]
    assert cdc.forget_differences(spark, zone, 2) == 1 and cdc.versions(spark, zone) == [2]


def test_latest_per_key_reads_its_input_once(spark, tmp_root):
    path = os.path.join(tmp_root, "rows")
    spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), (None, 1, "n"), (None, 1, "n")], "id string, ts int, v string") \
        .write.parquet(path)
    got = latest_per_key(spark.read.parquet(path), "id", ["ts"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a", 2, "y"), (None, 1, "n"), (None, 1, "n")], key=repr)


BOOKINGS = ("booking_id string, ts timestamp_ntz, date_id int, pickup_location string, vehicle_type string, "
            "reason_for_cancelling_by_customer string, driver_cancellation_reason string, "
            "incomplete_rides_reason string, booking_value double, ride_distance double, driver_ratings double, "
            "customer_rating double, month int, op string")


def booking(i, h, day, place="p", car="c", reason=None, value=1.25, km=2.0, rating=4.0, op="U"):
    return (i, t(h), day, place, car, reason, None, None, value, km, rating, None, day // 100, op)


def rebuilt(rows):
    """The three KPIs of the live rows, by group."""
    out = {}
    for r in rows:
        g = out.setdefault((r.date_id, r.pickup_location, r.vehicle_type), [0, 0, None])
        g[0] += 1
        if r.reason_for_cancelling_by_customer is None:
            g[1] += 1
            if r.booking_value is not None:
                g[2] = (g[2] or 0) + r.booking_value
    return {k: tuple(v) for k, v in out.items()}


def test_kept_kpis_equal_a_rebuild_after_every_change_set(spark, tmp_root):
    zone, state = os.path.join(tmp_root, "zone"), os.path.join(tmp_root, "state")
    sets = [
        [booking("a", 1, 20240101), booking("b", 1, 20240101, value=None), booking("c", 1, 20240201, reason="no"),
         booking(None, 1, 20240301), booking("e", 1, 20240401, place=None)],
        [booking("a", 2, 20240201, value=0.1), booking("c", 2, 20240201, car="d", km=0.0), booking("b", 2, 20240101, op="D")],
        [booking("a", 3, 20240201, op="D"), booking("b", 1, 20240101, value=9.0), booking("f", 1, 20240501)],
    ]
    for k, rows in enumerate([sets[0], sets[1], sets[1], sets[2]]):
        apply_changes(zone, spark.createDataFrame(rows, BOOKINGS), "booking_id", ["ts"], "month", log_changes=True)
        months = {m: sorted(os.listdir(f"{state}/{m}")) for m in os.listdir(state) if "=" in m} if k else {}
        for _ in range(2):      # a refresh again adds nothing
            kpi_state.refresh(spark, zone, state)
            kept = spark.read.parquet(state)
            got = {(r.date_id, r.pickup_location, r.vehicle_type): (r.rides, r.completed_rides, r.revenue)
                   for r in kpi_state.daily_rides_revenue(kept).collect()}
            assert got == rebuilt(live_rows(spark, zone).collect())
        if k:   # March and April are in no change set but the first
            for m in ("month=202403", "month=202404"):
                assert sorted(os.listdir(f"{state}/{m}")) == months[m]
    means = {r.vehicle_type: tuple(r)[1:] for r in kpi_state.averages_fare_per_km(spark.read.parquet(state)).collect()}
    cars = live_rows(spark, zone).where("vehicle_type = 'c'").agg(
        F.avg("driver_ratings"), F.avg("customer_rating"), F.avg("ride_distance"),
        F.sum("booking_value") / F.sum(F.when(F.col("booking_value").isNotNull(), F.col("ride_distance")))).first()
    assert means["c"] == tuple(cars) and means["d"] == (4.0, None, 0.0, None)
    rates = {r.vehicle_type: r.customer_cancel_rate for r in kpi_state.cancellation_rate(spark.read.parquet(state)).collect()}
    assert rates == {"c": 0.0, "d": 0.0}


def test_a_refresh_that_broke_off_adds_nothing_twice(spark, tmp_root, monkeypatch):
    zone, state = os.path.join(tmp_root, "zone"), os.path.join(tmp_root, "state")
    for rows in ([booking("a", 1, 20240101), booking("b", 1, 20240201)], [booking("a", 2, 20240101, value=3.0)]):
        apply_changes(zone, spark.createDataFrame(rows, BOOKINGS), "booking_id", ["ts"], "month", log_changes=True)

        def stop(*_):
            raise RuntimeError("lost")

        with monkeypatch.context() as m:    # the state is written, its marker is not
            m.setattr(kpi_state, "touch", stop)
            with pytest.raises(RuntimeError, match="lost"):
                kpi_state.refresh(spark, zone, state)
        kpi_state.refresh(spark, zone, state)
    got = {r.date_id: (r.rides, r.revenue) for r in kpi_state.daily_rides_revenue(spark.read.parquet(state)).collect()}
    assert got == {20240101: (1, 3.0), 20240201: (1, 1.25)}


def test_quality_counts_follow_the_zone(spark, tmp_root):
    from starlane.operators import quality_state as q

    zone, state = os.path.join(tmp_root, "zone"), os.path.join(tmp_root, "state")
    assert {r.failed for r in q.report(spark, state).collect()} == {0} and q.history(spark, state).count() == 0
    sets = [[booking("a", 1, 20240101, rating=9.0), booking("b", 1, 20240201, value=-1.0), booking(None, 1, 20240201)],
            [booking("a", 2, 20240101), booking("b", 2, 20240201, op="D"), booking("c", 1, 20240301, value=1e20)]]
    for rows in sets:
        events = spark.createDataFrame(rows, BOOKINGS).withColumn("customer_id", F.col("booking_id"))
        apply_changes(zone, events, "booking_id", ["ts"], "month", log_changes=True)
        for _ in range(2):
            q.refresh(spark, zone, state)
        kept = {r.check_name: r.failed for r in q.report(spark, state).collect()}
        now = live_rows(spark, zone)
        assert kept == {"rows": now.count(), **{n: now.where(c).count() for n, c in q.failing().items()}}
    assert {r.check_name: (r.before, r.after) for r in q.drift(spark, state, 1, 2).collect()} == {
        "rating_out_of_range": (1, 0), "negative_measure": (1, 0), "overflow_booking_value": (0, 1)}


def test_only_keys_with_other_content_are_compared_whole(spark, tmp_root, monkeypatch):
    seen, real = [], cdc.materialise
    monkeypatch.setattr(cdc, "materialise",
                        lambda df, path, *a, **k: (seen.append(os.path.basename(path)), real(df, path, *a, **k))[1])
    zone = os.path.join(tmp_root, "zone")

    def put(*rows):
        seen.clear()
        frame = spark.createDataFrame(list(rows), "id string, ts timestamp_ntz, a string, b string, month int")
        upsert_latest(zone, frame, "id", ["ts"], "month")
        return sorted((tuple(r) for r in spark.read.parquet(zone).collect()), key=repr)

    x, y, n, z = ("x", t(1), None, "w", 1), ("y", t(1), "y", None, 1), (None, t(1), "n", None, 1), ("z", t(1), "z", None, 2)
    put(x, y, n)
    assert put(x, y, n) == sorted([x, y, n], key=repr) and "stored" not in seen     # a replay
    assert put(x, z) == sorted([x, y, n, z], key=repr) and "stored" not in seen     # a new key beside a known row
    newer = ("x", t(1), "w", None, 1)       # the same values, NULL in another column
    assert put(newer, z) == sorted([newer, y, n, z], key=repr) and "stored" in seen
    assert put(x) == sorted([newer, y, n, z], key=repr)
