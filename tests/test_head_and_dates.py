"""Heads of a distinct view by an exact bound; impossible dates known by their text."""

import datetime as dt
import re

from starlane.functions import time as times
from starlane.operators import sorts


def test_head_in_full_order_compares_only_rows_that_may_be_first(spark, tmp_root):
    rows = [(f"d{i % 40:02d}" if i % 7 else None, i % 11, None if i % 5 else f"t{i % 3}") for i in range(2000)]
    spark.createDataFrame(rows, "d string, k int, t string").write.parquet(f"{tmp_root}/zone")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW head_rows AS SELECT DISTINCT * FROM parquet.`{tmp_root}/zone`")
    view = spark.table("head_rows")
    for n in (1, 2, 20, 40, 41, 100_000):   # 41 values with the null: from 42 on nothing bounds them
        got = sorts.head_in_full_order(view, n)
        assert got.collect() == sorts.head(view, n, sorts.full_order(view)).collect()
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        below = plan.index("Filter") > plan.index("Aggregate") if "Filter" in plan else None
        assert below == (True if 2 <= n <= 41 else None)    # under the view's distinct


def test_head_in_full_order_without_rows_or_of_nulls_alone(spark):
    empty = spark.createDataFrame([], "`a.b` string, k int")
    assert sorts.head_in_full_order(empty, 3).collect() == []
    nulls = spark.createDataFrame([(None, k) for k in (3, 1, 2, 2)], "`a.b` string, k int")
    assert [r[1] for r in sorts.head_in_full_order(nulls, 1).collect()] == [1]
    assert [r[1] for r in sorts.head_in_full_order(nulls, 3).collect()] == [1, 2, 2]


def test_only_feb_29_is_left_to_a_cast_that_fails(spark):
    days = [(y, m, d) for y in (2023, 2024) for m in range(14) for d in range(33)]
    shape = re.compile(times._ISO_DATE)

    def exists(y, m, d):
        try:
            return dt.datetime(y, m, d)
        except ValueError:
            return None

    for form in ("{}-{}-{}", "{}-{:02d}-{:02d}"):
        texts = [form.format(*x) for x in days]
        for t, x in zip(texts, days):
            assert bool(shape.fullmatch(t)) == (exists(*x) is not None or x == (2023, 2, 29)), t
        df = spark.createDataFrame([(t,) for t in texts], "d string").coalesce(1)
        got = [r[0] for r in df.select(times.parse_booking_ts("d", None)).collect()]
        assert got == [exists(*x) for x in days]
    clock = [(h, m, s) for h in range(27) for m, s in ((0, 0), (5, 59), (59, 7), (60, 0), (0, 60), (99, 1))]
    for form in ("{}:{}:{}", "{:02d}:{:02d}:{:02d}"):
        df = spark.createDataFrame([("2024-2-29", form.format(*x)) for x in clock], "d string, t string").coalesce(1)
        got = [r[0] for r in df.select(times.parse_booking_ts("d", "t")).collect()]
        assert got == [dt.datetime(2024, 2, 29, *x) if x[0] < 24 and max(x[1:]) < 60 else None for x in clock]
