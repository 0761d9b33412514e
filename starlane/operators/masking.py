"""Masking of personal identifiers (GOV-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask_ids(df: DataFrame, column: str, salt: str) -> DataFrame:
    """Add ``<column>_hash`` (salted SHA-256) and ``<column>_masked`` (letters
    and digits replaced by class).

    Without a salt a hash of a short id can be undone by listing the ids, so
    an empty one is refused."""
    if not salt:
        raise ValueError("mask_ids needs a salt (set starlane.pii.salt)")
    return df.withColumns({
        f"{column}_hash": F.sha2(F.concat(F.lit(salt), F.col(column)), 256),
        f"{column}_masked": F.mask(column, F.lit("X"), F.lit("x"), F.lit("n"), F.lit(None)),
    })


def pseudonym(column: str, salt: str, version: int) -> Column:
    """``v<version>-<keyed hash>`` of an identifier; NULL stays NULL.

    HMAC-like nesting keeps the salt from being extended; the version says
    which salt made it, so pseudonyms of two salts are never taken for equal."""
    if not salt:
        raise ValueError("a pseudonym needs a salt (set starlane.pii.salt)")
    inner = F.sha2(F.concat(F.lit(f"{salt}|inner|"), F.col(column)), 256)
    return F.concat(F.lit(f"v{version}-"), F.sha2(F.concat(F.lit(f"{salt}|outer|"), inner), 256))


def masked(df: DataFrame, columns: list[str], salt: str, version: int) -> DataFrame:
    """``df`` with the pseudonyms of ``columns`` in their place."""
    return df.withColumns({c: pseudonym(c, salt, version) for c in columns if c in df.columns})


def rotation_map(members: DataFrame, column: str, old: tuple[str, int], new: tuple[str, int]) -> DataFrame:
    """(old_id, new_id) of every member: what re-keys data published under the
    ``old`` (salt, version) without the plain identifiers.

    Made where the plain members are; the map itself links two sets of
    pseudonyms and belongs with the salts, not with what is published."""
    return members.where(F.col(column).isNotNull()).select(
        pseudonym(column, *old).alias("old_id"), pseudonym(column, *new).alias("new_id")).distinct()


def rotate(published: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Published rows under the new pseudonyms (a join with the map; an id that
    the map lacks raises, as it would go on under the old salt)."""
    joined = published.join(mapping, F.col(column) == F.col("old_id"), "left")
    lost = F.col(column).isNotNull() & F.col("new_id").isNull()
    fresh = F.when(lost, F.raise_error(F.lit(f"{column}: a pseudonym is not in the map")).cast("string")).otherwise(F.col("new_id"))
    return joined.select(*[fresh.alias(c) if c == column else F.col(c) for c in published.columns])
