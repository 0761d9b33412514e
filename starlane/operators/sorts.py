"""Ordering, heads and top-k (SRT-1..3).

``distinct_top_k`` is one plan: the distinct has a partial step, so repeated
rows are dropped before the shuffle, and the ordered limit keeps ``k`` rows per
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_order(df: DataFrame) -> list:
    """Ascending on every column, NULLs first (a total order on rows)."""
    return [F.col(f"`{c}`").asc_nulls_first() for c in df.columns]


def head(df: DataFrame, n: int = 5, order=None) -> DataFrame:
    """First ``n`` rows; ordered first when ``order`` is given (never compare
    an unordered head)."""
    return (df.orderBy(*order) if order else df).limit(n)


def head_in_full_order(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows in the order of all columns.

    The ``n``-th smallest distinct value of the first column bounds them: that
    many rows are there up to it.  It is found from that column alone (the
    planner drops a distinct below, which cannot change it), and as a filter on
    the column it goes below the distinct of a view, so only rows that may be
    among the first are compared whole.  The bound is exact; with fewer values
    than ``n`` there is none."""
    lead = F.col(f"`{df.columns[0]}`")
    values = df.select(lead.alias("v")).distinct().orderBy(F.col("v").asc_nulls_first()).limit(n).collect()
    if len(values) == n and values[-1]["v"] is not None:
        df = df.where(lead.isNull() | (lead <= F.lit(values[-1]["v"])))
    return head(df, n, full_order(df))


def distinct_top_k(df: DataFrame, k: int) -> DataFrame:
    """``SELECT DISTINCT * ... ORDER BY <all columns> LIMIT k``."""
    return df.distinct().orderBy(*full_order(df)).limit(k)
