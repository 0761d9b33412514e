"""Data-quality checks and anomaly detection (QLT-1, QLT-2).

``dq_report`` returns one row per check with the number of failing rows.
Each source is read in as few passes as possible: all row-level checks on the
cleaned zone are conditional counts in one aggregate; the raw-text checks are
observed (``DataFrame.observe``) while the cleaned zone is being written, so
the raw feed is not read again; duplicates are one keyed aggregate with a
map-side partial step; referential integrity for every foreign key is one
pass over the fact through broadcast left joins (a dimension above the
checked broadcast size gets its own ``left_anti`` shuffle join).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.functions.numeric import money, safe_double
from starlane.functions.text import clean_text, normalise_headers
from starlane.operators.cleaning import resolve_aliases, with_normalised_headers
from starlane.operators.dimensions import Dimension
from starlane.operators.lookup import by_surrogate_key, fits_broadcast, lookup
from starlane.schema import CLEANED_SCHEMA, MEASURE_COLS, SOURCE_COLS, STAR_SCHEMAS

RATING_MIN, RATING_MAX = 1.0, 5.0

# (fact foreign key, dimension)
FACT_FKS = [
    ("customer_sk", "dim_customer"), ("vehicle_sk", "dim_vehicle"),
    ("pickup_location_sk", "dim_location"), ("drop_location_sk", "dim_location"),
    ("payment_sk", "dim_payment"), ("customer_cancel_reason_sk", "dim_reason"),
    ("driver_cancel_reason_sk", "dim_reason"), ("incomplete_reason_sk", "dim_reason"),
]


def _stack(df_one_row: DataFrame, names: list[str]) -> DataFrame:
    """One-row frame of counts -> (check_name, failed) rows."""
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return df_one_row.selectExpr(f"stack({len(names)}, {pairs}) AS (check_name, failed)")


def _one_row(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    return df.agg(*[v.cast("long").alias(k) for k, v in counts.items()])


def cleaned_counts(cleaned: DataFrame) -> dict[str, Column]:
    """Row-level checks on the cleaned rows (one aggregate, one pass)."""
    out_of_range = lambda c: F.col(c).isNotNull() & ~F.col(c).between(RATING_MIN, RATING_MAX)
    return {
        "null_booking_id": F.count(F.when(F.col("booking_id").isNull(), 1)),
        "null_customer_id": F.count(F.when(F.col("customer_id").isNull(), 1)),
        "null_date_id": F.count(F.when(F.col("date_id").isNull(), 1)),
        "rating_out_of_range": F.count(F.when(out_of_range("driver_ratings")
                                              | out_of_range("customer_rating"), 1)),
        "overflow_booking_value": F.count(F.when(
            F.col("booking_value").isNotNull() & money("booking_value").isNull(), 1)),
        "_cleaned_rows": F.count(F.lit(1)),
    }


def schema_checks(raw: DataFrame, tables: dict[str, DataFrame]) -> dict[str, int]:
    """Checks on names and types, from schemas alone.

    ``missing_columns`` counts the logical columns that the *raw* feed does
    not bring (the cleaned zone fills those with typed NULLs, so it cannot
    tell); ``wrong_column_types`` the columns of written tables whose name is
    missing or whose type is not the declared one."""
    present = set(resolve_aliases(with_normalised_headers(raw.limit(0))).columns)
    declared = {"cleaned": CLEANED_SCHEMA, **STAR_SCHEMAS}
    wrong = 0
    for name, df in tables.items():
        actual = {f.name: f.dataType for f in df.schema.fields}
        wrong += sum(actual.get(f.name) != f.dataType for f in declared[name].fields)
    return {"missing_columns": len([c for c in SOURCE_COLS if c not in present]), "wrong_column_types": wrong}


def dimension_key_row(dims: dict[str, Dimension]) -> DataFrame:
    """Rows beyond the first per natural key and per surrogate key of each
    dimension (keyed aggregates with a partial step)."""
    rows = []
    for name, d in sorted(dims.items()):
        for key in (d.nk, d.sk):
            rows.append(duplicate_key_row(d.df, key).withColumnRenamed(f"duplicate_{key}", f"duplicate_{name}_{key}"))
    return _merge(rows)


def duplicate_key_row(cleaned: DataFrame, key: str = "booking_id") -> DataFrame:
    """Rows beyond the first per non-NULL key (keyed partial aggregate, skew-safe)."""
    per_key = cleaned.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long")
                       .alias(f"duplicate_{key}"))


def raw_check_metrics(raw: DataFrame) -> list[Column]:
    """Aggregates over the raw feed: non-blank measure text that does not
    parse as a number, one ``bad_<measure>`` count per measure present.
    Usable in ``agg`` or in ``observe`` (to piggy-back on another pass)."""
    by_name = dict(zip(normalise_headers(raw.columns), raw.columns))
    out = []
    for m in MEASURE_COLS:
        if m not in by_name:
            continue
        c = F.col(f"`{by_name[m]}`")
        bad = clean_text(c).isNotNull() & safe_double(c).isNull()
        out.append(F.count(F.when(bad, 1)).cast("long").alias(f"bad_{m}"))
    return out


def orphan_row(fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """One row: orphan count per fact foreign key, plus the fact row count.

    When every dimension is small enough to broadcast this is ONE pass over
    the fact (a chain of broadcast left joins and one aggregate).  A
    dimension above the checked size is checked through the shuffle path of
    ``lookup`` (keyed by surrogate key), where NULL and hot foreign keys are
    spread over the reducers as in the fact build.  Repeated members of a
    dimension count once, so they multiply no fact row.
    """
    spark = fact.sparkSession
    dims = {n: d if d.unique else replace(d, df=d.df.dropDuplicates([d.sk]), unique=True) for n, d in dims.items()}
    fks = [(fk, dims[d]) for fk, d in FACT_FKS if d in dims]
    small = [(fk, d) for fk, d in fks if fits_broadcast(spark, d)]
    large = [(fk, d) for fk, d in fks if not fits_broadcast(spark, d)]

    probe = fact.select(*sorted({fk for fk, _ in fks}))
    for i, (fk, d) in enumerate(small):
        keys = F.broadcast(d.df.select(F.col(d.sk).alias(f"_k{i}")))
        probe = probe.join(keys, F.col(fk) == F.col(f"_k{i}"), "left")
    counts = {"_fact_rows": F.count(F.lit(1))}
    counts.update({f"orphan_{fk}": F.count(F.when(F.col(fk).isNotNull() & F.col(f"_k{i}").isNull(), 1))
                   for i, (fk, _) in enumerate(small)})
    row = _one_row(probe, counts)
    for fk, d in large:
        matched = lookup(fact.select(fk), by_surrogate_key(d), fk, "_m")
        row = _merge([row, matched.agg(
            F.count(F.when(F.col(fk).isNotNull() & F.col("_m").isNull(), 1))
            .cast("long").alias(f"orphan_{fk}"))])
    return row


def _merge(rows: list[DataFrame]) -> DataFrame:
    """Several one-row frames with disjoint columns -> one row (each input is
    evaluated once; no cross join)."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def dq_report(cleaned: DataFrame, fact: DataFrame, dims: dict[str, Dimension],
              raw: DataFrame, raw_checks: dict | None = None) -> DataFrame:
    """All checks as ``(check_name string, failed bigint)``.

    Raw-text checks come from ``raw_checks`` (observed while the cleaned zone
    was written) or, failing that, from one pass over ``raw``; the schema of
    ``raw`` is checked in either case.
    """
    spark = cleaned.sparkSession
    parts = [_one_row(cleaned, cleaned_counts(cleaned)), duplicate_key_row(cleaned),
             dimension_key_row(dims), orphan_row(fact, dims)]
    known = schema_checks(raw, {"cleaned": cleaned, "fact_booking": fact, **{n: d.df for n, d in dims.items()}})
    known |= raw_checks or {}
    parts.append(spark.createDataFrame([tuple(int(v) for v in known.values())],
                                       ", ".join(f"{k} bigint" for k in known)))
    if not raw_checks:
        parts.append(raw.agg(*raw_check_metrics(raw)))
    row = _merge(parts)
    row = row.withColumn("fact_row_count_diff", F.abs(F.col("_cleaned_rows") - F.col("_fact_rows")))
    names = [c for c in row.columns if not c.startswith("_")]
    return _stack(row, names)


def daily_anomalies(fact: DataFrame, k: int = 3, trailing_days: int = 7) -> DataFrame:
    """Per day: rides and revenue, and whether each lies beyond ``k`` sample
    standard deviations of the trailing ``trailing_days`` calendar days.

    No ordered window (which would pull every day into one task): each
    day's aggregate is sent to the ``trailing_days`` days it precedes
    (``explode(sequence(day+1, day+N))``), summed per target day and joined
    back - the same frame as ``RANGE BETWEEN N PRECEDING AND 1 PRECEDING``,
    fully distributed, over an input of one row per day.  The test is exact
    integer arithmetic: ``|x - mean| > k * sd`` becomes
    ``(n*x - s1)^2 * (n-1) > k^2 * n * (n*s2 - s1^2)`` over counts and cents.
    """
    daily = fact.where(F.col("date_id").isNotNull()).groupBy("date_id").agg(
        F.count(F.lit(1)).alias("rides"),
        F.sum(money("booking_value")).alias("_rev"),
    )
    day = F.to_date(F.col("date_id").cast("string"), "yyyyMMdd")
    daily = daily.withColumns({
        "_day": F.datediff(day, F.lit("1970-01-01").cast("date")),
        "_rev_cents": (F.col("_rev") * 100).cast("decimal(38,0)"),
        "_rides": F.col("rides").cast("decimal(38,0)"),
    })
    sent = daily.select(
        F.explode(F.sequence(F.col("_day") + 1, F.col("_day") + trailing_days)).alias("_target"),
        "_rides", "_rev_cents")
    trailing = sent.groupBy("_target").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_rides").alias("_r1"), F.sum(F.col("_rides") * F.col("_rides")).alias("_r2"),
        F.sum("_rev_cents").alias("_v1"),
        F.sum(F.col("_rev_cents") * F.col("_rev_cents")).alias("_v2"))
    joined = daily.join(trailing, daily["_day"] == trailing["_target"], "left") \
        .withColumn("trailing_days", F.coalesce(F.col("_n"), F.lit(0)).cast("long"))
    n = F.col("trailing_days").cast("decimal(38,0)")
    k2 = F.lit(k * k).cast("decimal(38,0)")

    def beyond(x: str, s1: str, s2: str):
        dev = n * F.col(x) - F.col(s1)
        return F.coalesce((F.col("trailing_days") >= 2)
                          & (dev * dev * (n - 1) > k2 * n * (n * F.col(s2) - F.col(s1) * F.col(s1))),
                          F.lit(False))

    return joined.select(
        "date_id", "rides", F.col("_rev").cast("double").alias("revenue"),
        "trailing_days",
        (F.col("_r1").cast("double") / F.col("trailing_days")).alias("rides_trailing_mean"),
        beyond("_rides", "_r1", "_r2").alias("rides_anomaly"),
        beyond("_rev_cents", "_v1", "_v2").alias("revenue_anomaly"),
    )
