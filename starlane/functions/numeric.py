"""Guarded numeric casts (FN-12, FN-13): bad text, blanks, NaN and infinities
become NULL, so one bad value can neither fail a job nor poison a sum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starlane.functions.text import strip

MONEY = "decimal(18,2)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: Column | str) -> Column:
    """Finite number of a stripped text, else NULL (ANSI-safe)."""
    return finite(numeric_text(strip(_c(c))).try_cast("double"))


def numeric_text(x: Column) -> Column:
    """A stripped text, or NULL where it cannot be a finite number: it is
    empty or begins beyond the digits (``null``, ``NaN``, words).  A cast that
    fails throws inside and costs as much as many that do not."""
    text = x.cast("string")     # inferred types: numbers, and booleans that are 1 and 0
    return F.when(((text < "A") & (text != "")) | text.isin("true", "false"), x)


def finite(x: Column) -> Column:
    """A double, or NULL for NaN and the infinities."""
    return F.when(F.abs(x) < F.lit(float("inf")), x)  # false for NaN too


def safe_int(c: Column | str) -> Column:
    return strip(_c(c).cast("string")).try_cast("int")


def money(c: Column | str) -> Column:
    """Exact amount with two decimals; NULL if it does not fit."""
    return _c(c).try_cast(MONEY)
