"""KPIs kept up to date change set by change set (KPI-1..3, hourly refresh).

The state holds sums that can be taken back: per day, pickup location and
vehicle type the rides, the completed ones, and for every measure the sum and
how many values it is of.  A merge of the CDC zone leaves its difference, rows
with a sign (-1 a row's state before, 1 its state after); ``refresh`` adds the
signed sums to the state's partitions that they touch and to no other.  All
sums are of integers or decimals, so taking back is exact and the state equals
the one a rebuild makes.

A marker names the last merge that a whole refresh brought in, and every
partition the last that it has seen (``seen``), so a refresh that broke off, or
that is run again, adds nothing twice.  A group without
rides left stays with zero rides, as it carries that number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.functions.numeric import money
from starlane.operators import cdc
from starlane.session import child_names, delete_path, has_data_files, touch, work_dir
from starlane.sinks.files import materialise

GROUP = ["date_id", "pickup_location", "vehicle_type"]
MEASURES = ["driver_ratings", "customer_rating", "ride_distance"]   # kept to six decimals
EXACT = "decimal(38,6)"


def _completed() -> Column:
    return (F.col("reason_for_cancelling_by_customer").isNull() & F.col("driver_cancellation_reason").isNull()
            & F.col("incomplete_rides_reason").isNull())


def _parts() -> dict[str, Column]:
    """What one row adds, by column of the state."""
    fare = money("booking_value")
    paid = F.when(_completed(), fare)
    on_road = (F.col("ride_distance") > 0) & F.col("booking_value").isNotNull()
    one = lambda c: F.when(c, 1).otherwise(0)
    parts = {
        "rides": F.lit(1), "completed_rides": one(_completed()),
        "customer_cancellations": one(F.col("reason_for_cancelling_by_customer").isNotNull()),
        "driver_cancellations": one(F.col("driver_cancellation_reason").isNotNull()),
        "revenue": paid, "revenue_n": one(paid.isNotNull()),
        "fare": F.when(on_road, fare), "fare_n": one(on_road & fare.isNotNull()),
        "km": F.when(on_road, F.col("ride_distance")).try_cast(EXACT), "km_n": one(on_road)}
    for m in MEASURES:
        value = F.col(m).try_cast(EXACT)
        parts |= {m: value, f"{m}_n": one(value.isNotNull())}
    return parts


COUNTS = [c for c in ("rides", "completed_rides", "customer_cancellations", "driver_cancellations", "revenue_n",
                      "fare_n", "km_n", *[f"{m}_n" for m in MEASURES])]
SUMS = {"revenue": "decimal(38,2)", "fare": "decimal(38,2)", "km": EXACT, **{m: EXACT for m in MEASURES}}
PART = "month"


def signed_sums(moves: DataFrame) -> DataFrame:
    """Signed sums of a difference per partition and group (partial step first)."""
    parts = _parts()
    sign = F.col(cdc.SIGN)
    return moves.groupBy(PART, *GROUP).agg(
        *[F.sum(parts[c] * sign).cast("bigint").alias(c) for c in COUNTS],
        *[F.coalesce(F.sum(parts[c] * sign), F.lit(0)).cast(kind).alias(c) for c, kind in SUMS.items()])


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(PART, *GROUP).agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNTS],
                                          *[F.sum(c).cast(kind).alias(c) for c, kind in SUMS.items()])


def _applied(spark: SparkSession, state: str) -> int:
    """The last merge that a whole refresh has brought in."""
    return max((int(n[2:]) for n in child_names(spark, f"{state}__applied") if n.startswith("v=")), default=0)


def refresh(spark: SparkSession, zone: str, state: str, sums=signed_sums, added=_added) -> int:
    """Bring the state up to the zone's last merge; returns its number.

    Only partitions that the differences touch are read and rewritten.
    ``sums`` makes a state's rows from a difference, ``added`` adds up such
    rows; both keep the partition column."""
    known = cdc.versions(spark, zone)
    last, done = (known[-1] if known else 0), _applied(spark, state)
    moves = cdc.differences(spark, zone, done)
    if moves is None:
        return last
    kept = spark.read.parquet(state) if has_data_files(spark, state) else None
    # one row a partition of the state, the months of the calendar: what each has seen
    seen = {} if kept is None else {r[PART]: r["s"] for r in kept.groupBy(PART).agg(F.max("seen").alias("s")).collect()}
    if cdc.DELETED in moves.columns:
        moves = moves.where(~F.col(cdc.DELETED))    # tombstones count for nothing
    if seen:
        known_parts = spark.createDataFrame(list(seen.items()), kept.select(PART, "seen").schema).toDF("_m", "_seen")
        moves = moves.join(F.broadcast(known_parts), F.col(PART).eqNullSafe(F.col("_m")), "left") \
            .where(F.col("v") > F.coalesce("_seen", F.lit(0)))
    stage = work_dir(spark, "kpi_state")
    delta = materialise(sums(moves), f"{stage}/delta")
    if kept is not None:
        months = F.broadcast(delta.select(F.col(PART).alias("_t")).distinct())    # the calendar's months
        here = kept.join(months, F.col(PART).eqNullSafe(F.col("_t")), "left_semi").drop("seen")
        delta_and_kept = added(here.unionByName(delta))
    else:
        delta_and_kept = delta
    merged = materialise(delta_and_kept.withColumn("seen", F.lit(last)), f"{stage}/merged")
    merged.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(PART).parquet(state)
    touch(spark, f"{state}__applied/v={last}")
    delete_path(spark, stage)
    return last


# ---- the KPIs from the state -----------------------------------------------------------

def _or_null(total: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(total)).cast("double")


def daily_rides_revenue(state: DataFrame) -> DataFrame:
    rows = state.where("rides > 0")
    return rows.select(*GROUP, "rides", "completed_rides", _or_null("revenue", "revenue_n").alias("revenue"))


def _by_vehicle(state: DataFrame) -> DataFrame:
    return state.where("rides > 0").groupBy("vehicle_type").agg(*[F.sum(c).alias(c) for c in [*COUNTS, *SUMS]])


def cancellation_rate(state: DataFrame) -> DataFrame:
    rate = lambda c: (F.col(c).cast("double") / F.col("rides"))
    return _by_vehicle(state).select(
        "vehicle_type", "rides", "customer_cancellations", "driver_cancellations",
        rate("customer_cancellations").alias("customer_cancel_rate"),
        rate("driver_cancellations").alias("driver_cancel_rate"))


def averages_fare_per_km(state: DataFrame) -> DataFrame:
    mean = lambda c: F.try_divide(_or_null(c, f"{c}_n"), F.col(f"{c}_n").cast("double"))
    return _by_vehicle(state).select(
        "vehicle_type", mean("driver_ratings").alias("avg_driver_rating"),
        mean("customer_rating").alias("avg_customer_rating"), mean("ride_distance").alias("avg_ride_distance"),
        F.try_divide(_or_null("fare", "fare_n"), _or_null("km", "km_n")).alias("fare_per_km"))
