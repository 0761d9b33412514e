"""Surrogate-key lookups: the one join family of a star build (JOIN-1..6).

``fact LEFT JOIN dim ON fact.col = dim.nk``: a NULL or unmatched value gives
a NULL key and no input row is ever dropped.

Strategy, decided per lookup from the dimension's *exact* rows and key bytes:

* at most ``starlane.lookup.broadcastMaxBytes`` -> broadcast hash join.  The
  fact is never shuffled; a chain of such lookups is one map-only stage.
* larger -> shuffle (sort-merge) join.  Rows whose value is NULL can never
  match, yet would all hash to one reducer; their join key is a hash of the
  row and its position (guarded so it never matches), so they spread over all
  reducers.  A hot member (more than 1% of the rows by default, known from
  the member frequencies kept at build time) is salted over several
  reducers, its one dimension row replicated per salt; AQE's skew join
  remains as a second line for anything else.

A dimension with duplicate natural keys would multiply fact rows; dimensions
built here are unique by construction, foreign ones are checked first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlane.operators.dimensions import Dimension

DEFAULT_BROADCAST_MAX_BYTES = 128 * 1024 * 1024
DEFAULT_HOT_KEY_FRACTION = 0.01   # a member with more than 1% of the rows is hot
DEFAULT_HOT_KEY_SALTS = 32        # reducers a hot member is spread over


class DuplicateKeyError(ValueError):
    pass


def broadcast_max_bytes(spark) -> int:
    return int(spark.conf.get("starlane.lookup.broadcastMaxBytes", str(DEFAULT_BROADCAST_MAX_BYTES)))


def fits_broadcast(spark, dim: Dimension, max_bytes: int | None = None) -> bool:
    limit = broadcast_max_bytes(spark) if max_bytes is None else max_bytes
    return dim.broadcast_bytes() <= limit


def hot_members(dim: Dimension, fraction: float) -> list:
    """Members carrying more than ``fraction`` of all looked-up rows.

    At most ``1 / fraction`` members can qualify, so the list is bounded by
    configuration (100 at the default), never by data volume.
    """
    if dim.freq is None:
        return []
    total = dim.freq.agg(F.sum("freq")).first()[0] or 0
    if not total:
        return []
    # each hot member holds more than `fraction` of `total`, so fewer than
    # 1 / fraction of them exist: the collect is bounded without any cap
    hot = dim.freq.where(F.col("freq") > F.lit(fraction * total)).select(dim.nk)
    return [r[0] for r in hot.collect()]


def assert_unique(dim: DataFrame, nk: str) -> None:
    """Raise if any natural key occurs twice (one small aggregate job)."""
    dup = dim.groupBy(nk).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"dimension key {nk!r} is not unique, e.g. {dup[0][0]!r}")


def as_dimension(df: DataFrame, nk: str, sk: str, name: str = "dim") -> Dimension:
    """Wrap a foreign dimension: check key uniqueness, measure its size once."""
    assert_unique(df, nk)
    rows, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(nk).cast("string")))).first()
    return Dimension(name, df, nk, sk, rows, key_bytes=size or 0)


def by_surrogate_key(dim: Dimension, value: str | None = None) -> Dimension:
    """The same dimension keyed by surrogate key, giving ``value`` (the
    surrogate key itself by default); member frequencies are carried over."""
    given = F.col(value or dim.sk).alias("_value")
    keys = dim.df.select(F.col(dim.sk).alias("_key"), given)
    freq = None
    if dim.freq is not None:
        freq = dim.df.join(dim.freq, dim.nk).select(F.col(dim.sk).alias("_key"), "freq")
    return Dimension(dim.name, keys, "_key", "_value", dim.rows, key_bytes=dim.key_bytes, freq=freq)


def lookup(fact: DataFrame, dim: Dimension, on: str | Column, as_: str,
           max_bytes: int | None = None) -> DataFrame:
    """Add ``as_`` = the dimension's surrogate key for the fact's ``on`` value."""
    if not dim.unique:
        assert_unique(dim.df, dim.nk)
    spark = fact.sparkSession
    key = F.col(on) if isinstance(on, str) else on
    tmp = f"_{as_}_nk"
    right = dim.df.select(F.col(dim.nk).alias(tmp), F.col(dim.sk).alias(as_))

    if fits_broadcast(spark, dim, max_bytes):
        return fact.join(F.broadcast(right), key == F.col(tmp), "left").drop(tmp)

    # Shuffle path.
    # * NULL values can never match but would all hash to one reducer: their
    #   join key is replaced by a hash of the row, and a residual ``NOT is_null``
    #   keeps a salt from ever matching a real member.  The salt lives inside
    #   the equi-join key on purpose: a separate constant salt column would be
    #   folded by the optimizer into a residual filter.
    # * Hot members (more than a set fraction of all rows; known from the
    #   member frequencies kept when the dimension was built) are salted too:
    #   the fact rows of a hot member spread over ``salts`` reducers, and the
    #   dimension row of that member is replicated once per salt.
    #   Anything hotter than AQE's thresholds is still split by AQE.
    conf = spark.conf
    fraction = float(conf.get("starlane.lookup.hotKeyFraction", str(DEFAULT_HOT_KEY_FRACTION)))
    salts = int(conf.get("starlane.lookup.hotKeySalts", str(DEFAULT_HOT_KEY_SALTS)))
    hot = hot_members(dim, fraction)

    is_null, jkey, skey = f"_{as_}_isnull", f"_{as_}_jk", f"_{as_}_salt"
    key_type = fact.select(key.alias("_k")).schema[0].dataType
    # the position keeps equal rows (or a fact of the key alone) apart
    row_hash = F.xxhash64(*[F.col(c) for c in fact.columns], F.monotonically_increasing_id())
    fact_salt = F.lit(0)
    dim_salt = F.lit(0)
    if hot:
        fact_salt = F.when(key.isin(hot), F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0))
        dim_salt = F.explode(F.when(F.col(tmp).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1)))
                             .otherwise(F.array(F.lit(0))))  # int elements
    left = fact.withColumns({
        is_null: key.isNull(),
        jkey: F.coalesce(key, row_hash.cast(key_type)),
        skey: fact_salt.cast("int"),
    })
    rsalt = f"_{as_}_rsalt"
    right = right.withColumn(rsalt, dim_salt)
    cond = (F.col(jkey) == F.col(tmp)) & (F.col(skey) == F.col(rsalt)) & ~F.col(is_null)
    return left.join(right, cond, "left").drop(tmp, is_null, jkey, skey, rsalt)
