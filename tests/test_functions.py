"""Golden tests for column functions (one per edge case of the source rules)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starlane.functions.numeric import finite, safe_double
from starlane.functions.text import (
    WHITE,
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
from starlane.operators.cleaning import clean_bookings
from starlane.schema import CLEANED_COLS, RAW_HEADERS


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_header_rules():
    assert normalise_header(" Avg  VTAT! ") == "avg_vtat"
    assert normalise_header("Reason for cancelling by Customer") == "reason_for_cancelling_by_customer"
    assert normalise_header("\u00a0Booking\tID (new)_2 ") == "booking_id_new_2"
    with pytest.raises(ValueError, match="collision"):
        normalise_headers(["Booking ID", "booking id!"])


def test_title_case_matches_word_rule(spark):
    got = one_col(spark, [" CANCELLED by driver ", "no-show o'neil", "3rd ride", "", None],
                  lambda c: title_case(strip(c)))
    assert got == ["Cancelled By Driver", "No-Show O'Neil", "3Rd Ride", "", None]


def test_payment_map_trims_and_passes_through(spark):
    got = one_col(spark, ["Upi ", " Cash", "Wallet", " Debit Card ", None], map_payment)
    assert got == ["UPI", "Cash", "Wallet", "Debit Card", None]


def test_strip_quotes(spark):
    got = one_col(spark, ['"""CNR1"""', '"CID1"', "ab\"c", '""'], strip_quotes)
    assert got == ["CNR1", "CID1", "ab\"c", ""]


def test_clean_text_blank_to_null(spark):
    assert one_col(spark, ["  a ", "", "   ", None], clean_text) == ["a", None, None, None]


def test_safe_double(spark):
    got = one_col(spark, ["null", "", "  ", "NaN", " 1.5 ", "1e3", "abc", None, "Infinity", "-inf", "\t7\u00a0", "1e20"],
                  safe_double)
    assert got == [None, None, None, None, 1.5, 1000.0, None, None, None, None, 7.0, 1e20]


def test_parse_timestamp_lenient_and_null_on_failure(spark):
    df = spark.createDataFrame(
        [("2024-3-3", "1:2:3"), ("2024-02-30", "01:02:03"), ("2024-01-05", "25:00:00"),
         ("2024-01-05", None), (None, "10:00:00")], "d string, t string")
    got = [r[0] for r in df.select(parse_booking_ts("d", "t")).collect()]
    assert got == [dt.datetime(2024, 3, 3, 1, 2, 3), None, None, None, None]


def test_parse_date_only_when_no_time_column(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-1-6",), ("bad",)], "d string")
    got = [r[0] for r in df.select(parse_booking_ts("d", None)).collect()]
    assert got == [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6), None]


def test_date_id_and_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),)], "ts timestamp_ntz")
    cal = calendar_columns(F.to_date("ts"))
    r = df.select(date_id_of("ts").alias("id"), *[v.alias(k) for k, v in cal.items()]).first()
    assert r.asDict() == {"id": 20240101, "year": 2024, "month": 1, "quarter": 1,
                          "day_of_week": "Monday"}


def test_reason_type(spark):
    got = one_col(spark, ["Incomplete: driver ill", "Driver late", "Changed mind"], reason_type)
    assert got == ["incomplete", "driver_cancellation", "customer_cancellation"]


def test_safe_int(spark):
    from starlane.functions.numeric import safe_int

    assert one_col(spark, [" 20240101 ", "x", "", None], safe_int) == [20240101, None, None, None]


def test_parse_is_time_zone_independent(spark):
    # 02:30 on 2024-03-10 does not exist in Los Angeles (clocks jump 02:00 -> 03:00);
    # a booking time is a wall-clock value and must come back unchanged
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10", "2:30:00")], "d string, t string")
        got = df.select(parse_booking_ts("d", "t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == dt.datetime(2024, 3, 10, 2, 30)


def test_strip_takes_all_white_space(spark):
    assert one_col(spark, ["\tCash\r", "\u00a0a b\u2003", "\t", "\x1f\u3000x\x0b", None], strip) == \
        ["Cash", "a b", "", "x", None]
    assert one_col(spark, ["Upi\t", "\r\u00a0Cash"], map_payment) == ["UPI", "Cash"]
    assert one_col(spark, ["\t", "\u00a0"], clean_text) == [None, None]


def test_money_that_does_not_fit_is_null(spark):
    from starlane.functions.numeric import money

    got = one_col(spark, [1.239, 1e20, None], money, "double")
    assert [None if v is None else str(v) for v in got] == ["1.24", None, None]


def test_parse_format_list(spark):
    rows = [("2024-3-3", "1:2:3"), ("3/4/2024", "1:2:3"), ("20240305", "1:2:3"), ("31/4/2024", "1:2:3"),
            ("4/31/2024", "1:2:3"), ("Mar 3 2024", "1:2:3"), ("2024-3", "1:2:3")]
    df = spark.createDataFrame(rows, "d string, t string")
    got = [r[0] for r in df.select(parse_formats("d", "t", ["yyyy-M-d", "d/M/yyyy", "M/d/yyyy", "yyyyMMdd"])).collect()]
    at = lambda m, d: dt.datetime(2024, m, d, 1, 2, 3)
    assert got == [at(3, 3), at(4, 3), at(3, 5), None, None, None, None]


def test_the_timestamp_parse_splits_nothing(spark):
    df = spark.createDataFrame([("2024-3-3", "1:2:3")], "d string, t string")
    plan = df.select(parse_booking_ts("d", "t").alias("ts")).where("ts is not null")._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("split(") == 0


def test_texts_that_cannot_be_finite_numbers_are_not_cast(spark):
    from starlane.functions.numeric import numeric_text

    values = ["", "null", "NaN", "Infinity", "inf", "abc", "1.5", "-2", "+3", ".5", "1e20", "1d", "0x1p3", "\x01 4", "-Infinity", None]
    rows = spark.createDataFrame([(v,) for v in values], "x string").select(
        "x", numeric_text(F.col("x")).alias("n"), safe_double("x").alias("new"), finite(F.col("x").try_cast("double")).alias("old"))
    got = rows.collect()
    assert [r.n for r in got[:6]] == [None] * 6
    assert [r.new for r in got] == [r.old for r in got]


def test_fast_paths_of_strip_and_title_case(spark):
    values = ["", " ", "a", "a ", " é", "é", "\x7fx", "x\x7f", "plain text", "two  gaps", "no-show o'neil", "x1y", "ends \n", "ǆ a"]
    rows = spark.createDataFrame([(v,) for v in values], "x string").select(
        "x", strip("x").alias("s"), F.btrim("x", F.lit(WHITE)).alias("trimmed"), title_case("x").alias("t"))
    for r in rows.collect():
        assert r.s == r.trimmed
        if r.x.isascii():
            assert r.t == "".join(c.upper() if not r.x[i - 1:i].isalpha() else c.lower() for i, c in enumerate(r.x))


def test_cheap_ends_of_strip_and_quotes(spark):
    values = [" a ", "  two words ", "\ta ", " \u00a0b", "é ", " x\u2003", '" a"', '"', 'a"b', "", None]
    rows = spark.createDataFrame([(v,) for v in values], "x string")
    for r in rows.select(strip("x").alias("s"), F.btrim("x", F.lit(WHITE)).alias("trimmed"),
                         strip_quotes("x").alias("q"), F.btrim("x", F.lit('"')).alias("bare")).collect():
        assert (r.s, r.q) == (r.trimmed, r.bare)
    # numbers stay text without quotes, as with quotes
    assert rows.select(strip_quotes(F.lit(7)).alias("q")).schema["q"].dataType.simpleString() == "string"


def test_cleaning_is_four_projections(spark):
    raw = spark.createDataFrame([(*["1"] * len(RAW_HEADERS),)], RAW_HEADERS)
    read = clean_bookings(raw.localCheckpoint()).select(*CLEANED_COLS)
    assert read._jdf.queryExecution().optimizedPlan().toString().count("Project [") == 4


def test_strip_and_number_casts_take_inferred_types(spark):
    rows = spark.sql("SELECT 2.5D AS d, 7 AS i, true AS b, DATE'2024-01-02' AS day")
    got = rows.select(strip("d").alias("d"), safe_double("d").alias("n"), safe_double("i").alias("i"),
                      safe_double("b").alias("b"), strip("day").cast("string").alias("day")).first()
    assert (got.d, got.n, got.i, got.b, got.day) == (2.5, 2.5, 7.0, 1.0, "2024-01-02")
