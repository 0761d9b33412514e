"""Data-quality counts kept up to date merge by merge, with their history
(QLT-1, monitoring over time).

The state has one row a partition: how many rows there are and how many fail
each row-level check.  Such counts merge and can be taken back, so a merge's
difference is enough: a refresh reads neither the zone nor the partitions of
the state that the difference leaves alone.  Each report is kept under the
merge it belongs to, and ``drift`` shows what moved between two of them.

Keys of a merged zone are unique by construction and its types are declared, so
the duplicate and type checks of ``dq_report`` are not repeated here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.functions.numeric import money
from starlane.operators import cdc, kpi_state
from starlane.operators.quality import RATING_MAX, RATING_MIN
from starlane.session import child_names, has_data_files
from starlane.sinks.files import write_parquet

PART = kpi_state.PART


def failing() -> dict[str, Column]:
    """The row-level checks: true for a row that fails."""
    odd = lambda c: F.col(c).isNotNull() & ~F.col(c).between(RATING_MIN, RATING_MAX)
    return {
        "null_booking_id": F.col("booking_id").isNull(),
        "null_customer_id": F.col("customer_id").isNull(),
        "null_date_id": F.col("date_id").isNull(),
        "rating_out_of_range": odd("driver_ratings") | odd("customer_rating"),
        "overflow_booking_value": F.col("booking_value").isNotNull() & money("booking_value").isNull(),
        "negative_measure": F.coalesce(F.least("booking_value", "ride_distance") < 0, F.lit(False)),
    }


def _signed(moves: DataFrame) -> DataFrame:
    sign = F.col(cdc.SIGN)
    counts = {"rows": F.lit(True), **failing()}
    return moves.groupBy(PART).agg(
        *[F.sum(F.when(c, sign).otherwise(0)).cast("bigint").alias(n) for n, c in counts.items()])


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(PART).agg(*[F.sum(n).cast("bigint").alias(n) for n in ["rows", *failing()]])


def refresh(spark: SparkSession, zone: str, state: str) -> int:
    """Bring the counts up to the zone's last merge and keep the report."""
    last = kpi_state.refresh(spark, zone, state, _signed, _added)
    if last:
        write_parquet(report(spark, state), f"{state}__reports/v={last}")
    return last


def report(spark: SparkSession, state: str) -> DataFrame:
    """``check_name, failed`` over all partitions, with the number of rows."""
    names = ["rows", *failing()]
    if has_data_files(spark, state):
        total = spark.read.parquet(state).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])
    else:
        total = spark.range(1).select(*[F.lit(0).cast("bigint").alias(n) for n in names])
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return total.selectExpr(f"stack({len(names)}, {pairs}) AS (check_name, failed)")


def history(spark: SparkSession, state: str) -> DataFrame:
    """``v, check_name, failed`` of every report kept."""
    kept = any(n.startswith("v=") for n in child_names(spark, f"{state}__reports"))
    schema = "check_name string, failed bigint, v bigint"
    return spark.read.schema(schema).parquet(f"{state}__reports") if kept else spark.createDataFrame([], schema)


def drift(spark: SparkSession, state: str, since: int, until: int) -> DataFrame:
    """``check_name, before, after`` of the checks whose count moved."""
    seen = history(spark, state)
    at = lambda v, name: seen.where(F.col("v") == v).select("check_name", F.col("failed").alias(name))
    both = at(since, "before").join(at(until, "after"), "check_name", "full")
    return both.where(~F.col("before").eqNullSafe(F.col("after")))
