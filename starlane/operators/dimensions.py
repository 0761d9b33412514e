"""Conformed dimensions (AGG-1, AGG-5..7, SET-1..3, FLT-1..3).

Distinct values are gathered with one scan of the cleaned rows: several
source columns (role-playing pickup/drop, the three reason columns) are
unpivoted with ``explode(array(...))`` instead of a union of scans, and the
distinct is a partial + final hash aggregate, so a hot value is combined on
the map side before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.functions.text import reason_type
from starlane.functions.time import calendar_columns
from starlane.operators.keys import Keyed, assign_dense_keys
from starlane.schema import REASON_COLS

# dimension -> (source columns, natural key, surrogate key)
DIM_SPECS = {
    "dim_customer": (["customer_id"], "customer_id", "customer_sk"),
    "dim_vehicle": (["vehicle_type"], "vehicle_type", "vehicle_sk"),
    "dim_location": (["pickup_location", "drop_location"], "location_name", "location_sk"),
    "dim_payment": (["payment_method"], "payment_method", "payment_sk"),
    "dim_reason": (REASON_COLS, "reason_text", "reason_sk"),
}


REASON_SOURCES = ("customer", "driver", "incomplete")   # roles of REASON_COLS


@dataclass
class Dimension:
    """A dimension frame plus what a lookup needs to know about it."""
    name: str
    df: DataFrame
    nk: str          # natural key column
    sk: str          # surrogate key column
    rows: int        # exact row count
    key_bytes: int | None = None  # exact total length of the natural keys
    unique: bool = True
    freq: DataFrame | None = None   # (nk, freq): source rows per member, for hot keys

    def broadcast_bytes(self) -> int:
        """Size as a broadcast table: keys (unknown lengths count as 1 KB a
        row) plus surrogate key and hash-table overhead per row."""
        keys = self.rows * 1024 if self.key_bytes is None else self.key_bytes
        return keys + 64 * self.rows


def distinct_values(df: DataFrame, cols: list[str], as_name: str,
                    with_freq: bool = False) -> DataFrame:
    """Distinct non-NULL values over one or more columns, as one column
    (plus ``freq``, the number of source values, when asked - same cost:
    a partial + final hash aggregate either way)."""
    if len(cols) == 1:
        vals = df.select(F.col(cols[0]).alias(as_name))
    else:
        vals = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(as_name))
    vals = vals.where(F.col(as_name).isNotNull())
    if with_freq:
        return vals.groupBy(as_name).agg(F.count(F.lit(1)).alias("freq"))
    return vals.distinct()


def build_dim(df: DataFrame, name: str, cols: list[str], nk: str, sk: str,
              num_partitions: int | None = None) -> Dimension:
    keyed = assign_dense_keys(distinct_values(df, cols, nk, with_freq=True), nk, sk,
                              num_partitions)
    full = keyed.df
    return Dimension(name, full.select(sk, nk), nk, sk, keyed.rows,
                     key_bytes=sum(keyed.group_bytes.values()), freq=full.select(nk, "freq"))


def build_dim_customer(cleaned: DataFrame, **kw) -> Dimension:
    return build_dim(cleaned, "dim_customer", ["customer_id"], "customer_id", "customer_sk", **kw)


def build_dim_vehicle(cleaned: DataFrame, **kw) -> Dimension:
    return build_dim(cleaned, "dim_vehicle", ["vehicle_type"], "vehicle_type", "vehicle_sk", **kw)


def build_dim_payment(cleaned: DataFrame, **kw) -> Dimension:
    return build_dim(cleaned, "dim_payment", ["payment_method"], "payment_method",
                     "payment_sk", **kw)


def build_dim_location(cleaned: DataFrame, **kw) -> Dimension:
    """One location dimension for both roles (pickup, drop)."""
    return build_dim(cleaned, "dim_location", ["pickup_location", "drop_location"],
                     "location_name", "location_sk", **kw)


def build_dim_reason(cleaned: DataFrame, **kw) -> Dimension:
    """Union of the three reason columns, typed by wording."""
    d = build_dim(cleaned, "dim_reason", REASON_COLS, "reason_text", "reason_sk", **kw)
    d.df = d.df.withColumn("type", reason_type("reason_text"))
    return d


def build_dim_date(cleaned: DataFrame) -> DataFrame:
    """One row per calendar day present; rows without a date are dropped.

    ``date`` is a function of ``date_id``, so keeping any value per key
    (here the minimum, which is deterministic) equals the keyed any-value.
    """
    days = (cleaned.where(F.col("booking_date").isNotNull())
            .groupBy("date_id").agg(F.min("booking_date").alias("date")))
    return days.select("date_id", "date", *[e.alias(n) for n, e in
                                            calendar_columns("date").items()]) \
        .select("date_id", "date", "year", "month", "quarter", "day_of_week")


DIMENSION_BUILDERS = {  # one dimension at a time (each scans its source)
    "dim_customer": build_dim_customer,
    "dim_vehicle": build_dim_vehicle,
    "dim_location": build_dim_location,
    "dim_payment": build_dim_payment,
    "dim_reason": build_dim_reason,
}


# ---- all dimensions in one pass over the fact ---------------------------------

def dimension_members(df: DataFrame, names=tuple(DIM_SPECS), with_freq: bool = False) -> DataFrame:
    """Distinct ``(dim, value)`` pairs for several dimensions from ONE scan.

    Every row is unpivoted into one ``(dim, value)`` pair per source column;
    the distinct is a partial + final hash aggregate, so hot values are
    combined before the shuffle.  ``with_freq`` also keeps how many source
    values each member has (what a lookup needs to find hot keys).
    """
    pairs = [F.struct(F.lit(n).alias("dim"), F.col(c).cast("string").alias("value"))
             for n in names for c in DIM_SPECS[n][0]]
    vals = (df.select(F.explode(F.array(*pairs)).alias("_p"))
            .select("_p.dim", "_p.value").where(F.col("value").isNotNull()))
    if with_freq:
        return vals.groupBy("dim", "value").agg(F.count(F.lit(1)).alias("freq"))
    return vals.distinct()


def key_members(members: DataFrame, num_partitions: int | None = None,
                group_offsets: dict | None = None) -> Keyed:
    """Dense keys per dimension over ``(dim, value)`` pairs: ``(sk, dim, value, type)``."""
    keyed = assign_dense_keys(members, "value", "sk", num_partitions,
                              group="dim", group_offsets=group_offsets)
    keyed.df = keyed.df.withColumn(
        "type", F.when(F.col("dim") == "dim_reason", reason_type("value")))
    return keyed


def reason_sources(cleaned: DataFrame, dim: Dimension) -> DataFrame:
    """Members of the reason dimension with ``source_type``: the columns each
    text occurs in, in column order (a wording rule alone mistypes driver
    reasons that lack the word)."""
    pairs = [F.struct(F.col(c).alias("reason_text"), F.lit(i).alias("place")) for i, c in enumerate(REASON_COLS)]
    seen = (cleaned.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
            .where(F.col("reason_text").isNotNull()).groupBy("reason_text")
            .agg(*[F.max((F.col("place") == i).cast("int")).alias(f"in_{i}") for i in range(len(REASON_COLS))]))
    label = F.concat_ws("+", *[F.when(F.col(f"in_{i}") == 1, F.lit(n)) for i, n in enumerate(REASON_SOURCES)])
    return dim.df.join(seen.select("reason_text", label.alias("source_type")), "reason_text")


def dimension_from_store(store: DataFrame, name: str, rows: int, key_bytes: int | None = None) -> Dimension:
    """One dimension out of a ``(sk, dim, value, type[, freq])`` store."""
    _, nk, sk = DIM_SPECS[name]
    cols = [F.col("sk").alias(sk), F.col("value").alias(nk)]
    if name == "dim_reason":
        cols.append(F.col("type"))
    part = store.where(F.col("dim") == name)
    freq = part.select(F.col("value").alias(nk), "freq") if "freq" in store.columns else None
    return Dimension(name, part.select(*cols), nk, sk, rows, key_bytes=key_bytes, freq=freq)
