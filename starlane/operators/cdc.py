"""Change data capture: last-write-wins per key, and upserts and deletes in a
partitioned Parquet zone (CDC-1).

"Latest row per key" is a keyed ``max`` over a struct whose first field is
the ordering timestamp and whose remaining fields are every other column (a
total, deterministic tie-break, since ids may repeat with different
content).  Unlike ``row_number() OVER (PARTITION BY key ...)`` this aggregate
has a map-side partial step (a sort aggregate, since the buffer holds text),
so a key holding a third of all rows is reduced before the shuffle instead of
landing whole in one task.

A deleted key leaves a tombstone, its last state with the time of the delete,
in the zone's partitions ``deleted=true``: an older update that comes late
loses against it like against any newer row, so change sets give the same end
state in any order.  ``live_rows`` reads the other partitions.

Every merge is prepared whole in ``<zone>__log/v=<n>`` (the new content of the
touched partitions, and the difference as rows with a sign) before the zone is
touched, and marked when it is done.  What a broken run has prepared is put
through by the next call, so neither the zone nor a reader of the differences
(``kpi_state``) can miss or double a change.  One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.session import child_names, delete_path, has_data_files, path_exists, touch, work_dir
from starlane.sinks.files import materialise, write_parquet

# Keys or partition values (short texts or numbers) broadcast at most: under 100 MB.
TOUCHED_BROADCAST_ROWS = 500_000
DELETED = "deleted"     # partition column of zones that keep tombstones
SIGN = "change_sign"    # of a difference: -1 a row that went, 1 one that came


def latest_per_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Keep, per non-NULL ``key``, the row greatest by ``order_by`` then by
    every remaining column (NULLs lowest).  Rows with a NULL key cannot be
    matched to anything and pass through unchanged.

    The input is read once: a row without key has a group of its own, made of
    its hash and position."""
    rest = [c for c in df.columns if c != key and c not in order_by]
    fields = order_by + rest
    alone = F.when(F.col(key).isNull(), F.struct(F.xxhash64(*df.columns).alias("h"),
                                                 F.monotonically_increasing_id().alias("i")))
    marked = df.withColumn("_alone", alone)
    best = marked.groupBy(key, "_alone").agg(F.max(F.struct(*[F.col(c) for c in fields])).alias("_w"))
    return best.select(key, *[F.col(f"_w.{c}").alias(c) for c in fields]).select(*df.columns)


def _by_partition(df: DataFrame, partition_cols: list[str], key: str) -> DataFrame:
    """Range-partition on (partition values, key): each task writes a
    contiguous run of partitions (few files per directory), and a partition
    holding a third of all rows still spreads over several tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *partition_cols, key)


def _partition_dir(spark, root: str, cols: list[str], values) -> str:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    parts = []
    for col, value in zip(cols, values):
        text = str(value).lower() if isinstance(value, bool) else str(value)
        parts.append(f"{escape(col)}={'__HIVE_DEFAULT_PARTITION__' if value is None else escape(text)}")
    return "/".join([root.rstrip("/"), *parts])


def _small(df: DataFrame) -> DataFrame:
    """A written table, broadcast when its counted rows allow it."""
    return F.broadcast(df) if df.count() <= TOUCHED_BROADCAST_ROWS else df


def _same(left: DataFrame, right: DataFrame, cols: list[str], prefix: str = "_p_"):
    """``left`` and ``right`` (its columns renamed) agree on ``cols``, NULLs equal."""
    cond = None
    for c in cols:
        one = left[c].eqNullSafe(right[prefix + c])
        cond = one if cond is None else cond & one
    return cond


def _renamed(df: DataFrame, cols: list[str], prefix: str = "_p_") -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


# ---- the log of prepared merges ---------------------------------------------------

def log_path(zone: str) -> str:
    return f"{zone.rstrip('/')}__log"


def versions(spark: SparkSession, zone: str) -> list[int]:
    """Numbers of the prepared merges of a zone, ascending (a folder listing)."""
    names = child_names(spark, log_path(zone))
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and path_exists(spark, f"{log_path(zone)}/{n}/_PREPARED"))


def _put_through(spark: SparkSession, zone: str, version: int, partition_cols: list[str]) -> None:
    """Swap a prepared merge in: overwrite the partitions that have rows, drop
    the touched ones that have none.  Doing it again changes nothing."""
    own = f"{log_path(zone)}/v={version}"
    if path_exists(spark, f"{own}/merged/_SUCCESS"):
        staged = spark.read.parquet(f"{own}/merged")
        # a zone's first content is written plainly, which leaves the commit marker
        kind = "static" if path_exists(spark, f"{own}/_FIRST") else "dynamic"
        staged.write.mode("overwrite").option("partitionOverwriteMode", kind) \
            .partitionBy(*partition_cols).parquet(zone)
        # touched partitions that received no merged row: their list is bounded by the zone's partitions
        touched = spark.read.parquet(f"{own}/touched")
        kept = _renamed(staged.select(*partition_cols).distinct(), partition_cols)
        for row in touched.join(kept, _same(touched, kept, partition_cols), "left_anti").collect():
            delete_path(spark, _partition_dir(spark, zone, partition_cols, row))
    touch(spark, f"{own}/_APPLIED")
    for done in ("merged", "touched"):
        delete_path(spark, f"{own}/{done}")


def recover(spark: SparkSession, zone: str, partition_cols: list[str]) -> int:
    """Put through what an interrupted run had prepared; how many merges."""
    todo = [v for v in versions(spark, zone) if not path_exists(spark, f"{log_path(zone)}/v={v}/_APPLIED")]
    for v in todo:
        _put_through(spark, zone, v, partition_cols)
    return len(todo)


def differences(spark: SparkSession, zone: str, after: int = 0) -> DataFrame | None:
    """Rows that went (``change_sign`` -1) and came (1) in the merges after
    number ``after``, with the merge's number ``v``; None without any."""
    todo = [v for v in versions(spark, zone) if v > after]
    if not todo:
        return None
    root = log_path(zone)
    out = None
    for v in todo:
        part = spark.read.parquet(f"{root}/v={v}/changes").withColumn("v", F.lit(v))
        out = part if out is None else out.unionByName(part)
    return out


def forget_differences(spark: SparkSession, zone: str, up_to: int) -> int:
    """Drop the log of merges that every reader has seen; the last one stays
    (it holds the count)."""
    known = versions(spark, zone)
    old = [v for v in known[:-1] if v <= up_to and path_exists(spark, f"{log_path(zone)}/v={v}/_APPLIED")]
    return sum(delete_path(spark, f"{log_path(zone)}/v={v}") for v in old)


# ---- merging -------------------------------------------------------------------------

def _merge(zone: str, changes: DataFrame, key: str, order_by: list[str], partition_cols: list[str],
           log_changes: bool) -> int:
    spark = changes.sparkSession
    recover(spark, zone, partition_cols)
    known = versions(spark, zone)
    version = known[-1] + 1 if known else 1
    own = f"{log_path(zone)}/v={version}"
    delete_path(spark, own)     # what a run left that never came to prepare it
    stage = work_dir(spark, "upsert")
    fields = [*order_by, *[c for c in changes.columns if c != key and c not in order_by]]
    first = not path_exists(spark, f"{zone}/_SUCCESS")
    if first and has_data_files(spark, zone):
        raise ValueError(f"{zone} holds data but no commit marker: it was not written by an upsert, or not whole; "
                         "nothing was changed")
    # the change set is read once: keys, partitions and rows come from the stage
    new = materialise(latest_per_key(changes, key, order_by), f"{stage}/changes")
    if first:
        if log_changes:     # prepared like any other, so that zone and difference cannot part
            write_parquet(new.withColumn(SIGN, F.lit(1)), f"{own}/changes")
            write_parquet(new.select(*partition_cols).distinct(), f"{own}/touched")
            write_parquet(_by_partition(new, partition_cols, key), f"{own}/merged")
            delete_path(spark, stage)
            touch(spark, f"{own}/_FIRST")
            touch(spark, f"{own}/_PREPARED")
            _put_through(spark, zone, version, partition_cols)
        else:
            write_parquet(_by_partition(new, partition_cols, key), zone, partition_by=partition_cols)
        delete_path(spark, stage)
        return version

    target = spark.read.schema(changes.schema).parquet(zone)
    has_key = F.col(key).isNotNull()
    columns = changes.columns
    keyed = new.where(has_key)
    # no more of the zone is moved than a key and two hashes a row; only the keys
    # that are stored with other content go through the comparison of whole rows
    nulls = F.array(*[F.col(c).isNull() for c in columns])     # a hash passes over NULLs
    prints = [F.xxhash64(nulls, *columns).alias("_h"), F.xxhash64(F.lit(7), nulls, *columns).alias("_i")]
    ours = materialise(keyed.select(key, *prints), f"{stage}/prints").toDF(key, "_new_h", "_new_i")
    equal = (F.col("_h") == F.col("_new_h")) & (F.col("_i") == F.col("_new_i"))
    met = target.where(has_key).select(key, *prints).join(_small(ours), key).groupBy(key) \
        .agg(((F.count(F.lit(1)) == 1) & F.every(equal)).alias("_equal"))
    met = materialise(met, f"{stage}/met")
    n_met, n_other = met.agg(F.count(F.lit(1)), F.count(F.when(~F.col("_equal"), 1))).first()
    fresh = keyed
    if n_met:
        fresh = materialise(keyed.join(_small(met.select(key)), key, "left_anti").select(*columns), f"{stage}/fresh")
    gone = best = None
    come = fresh
    if n_other:
        keys = _small(met.where(~F.col("_equal")).select(key))
        state = F.struct(*fields).alias("_state")
        stored = materialise(target.join(keys, key, "left_semi").select(key, state), f"{stage}/stored")
        both = stored.unionByName(keyed.join(keys, key, "left_semi").select(key, state))
        best = materialise(both.groupBy(key).agg(F.max("_state").alias("_best")), f"{stage}/best")
        # rows that go: stored ones that are not the best; rows that come: best ones that are not stored
        paired = stored.join(best, key)
        gone = paired.where(~F.col("_state").eqNullSafe(F.col("_best"))).select(key, "_state.*").select(*columns)
        gone = materialise(gone, f"{stage}/gone")
        kept = paired.where(F.col("_state").eqNullSafe(F.col("_best"))).select(key)
        come = come.unionByName(best.join(kept, key, "left_anti").select(key, "_best.*").select(*columns))
    # rows without key that are stored already, as often as they are, are no news;
    # an equal row is in the same partition, so only those partitions are read
    loose = new.where(~has_key)
    places = _small(materialise(_renamed(loose.select(*partition_cols).distinct(), partition_cols), f"{stage}/places"))
    held = target.where(~has_key).join(places, _same(target, places, partition_cols), "left_semi")
    loose = materialise(loose.select(*columns).exceptAll(held.select(*columns)), f"{stage}/loose")
    come = come.unionByName(loose)

    touched = come.select(*partition_cols)
    if gone is not None:
        touched = touched.unionByName(gone.select(*partition_cols))
    touched = materialise(touched.distinct(), f"{own}/touched")
    if touched.isEmpty():
        delete_path(spark, own)
        delete_path(spark, stage)
        return version - 1
    places = _small(_renamed(touched, partition_cols))
    # other keys stay as they are; of the changed ones, the best rows of these partitions
    merged = target.join(places, _same(target, places, partition_cols), "left_semi").select(*columns)
    if best is not None:
        best_rows = best.select(key, "_best.*").select(*columns)
        best_rows = best_rows.join(places, _same(best_rows, places, partition_cols), "left_semi")
        merged = merged.join(keys, key, "left_anti").select(*columns).unionByName(best_rows)
    merged = merged.unionByName(fresh).unionByName(loose)
    if log_changes:
        moves = come.withColumn(SIGN, F.lit(1))
        if gone is not None:
            moves = moves.unionByName(gone.withColumn(SIGN, F.lit(-1)))
        write_parquet(moves, f"{own}/changes")
    merged = materialise(merged, f"{stage}/merged")
    # from here on only the merged rows are read: one copy of them at a time
    for done in child_names(spark, stage):
        if done != "merged":
            delete_path(spark, f"{stage}/{done}")
    write_parquet(_by_partition(merged, partition_cols, key), f"{own}/merged")
    delete_path(spark, stage)
    touch(spark, f"{own}/_PREPARED")
    _put_through(spark, zone, version, partition_cols)
    if not log_changes:
        delete_path(spark, own)
    return version


def upsert_latest(target_path: str, changes: DataFrame, key: str, order_by: list[str],
                  partition_col: str, log_changes: bool = False) -> int:
    """Merge ``changes`` into a Parquet zone partitioned by ``partition_col``.

    Only touched partitions are rewritten: those receiving changed rows, and
    those still holding an older version of a changed key (a booking can move
    to another date; its old partition must lose the stale row).  Rows of other
    keys are carried over without being grouped.  A touched partition left with
    no rows is deleted.

    Re-running a change set gives the same table: rows already stored (as
    often as they are) are no change, and neither are rows without key, that no
    version could be matched to.  A target that holds data without commit
    marker raises and keeps its files.  Returns the number of the last merge;
    ``log_changes`` keeps its difference (see ``differences``)."""
    return _merge(target_path, changes, key, order_by, [partition_col], log_changes)


def apply_changes(zone: str, events: DataFrame, key: str, order_by: list[str], partition_col: str,
                  op_col: str = "op", log_changes: bool = False) -> int:
    """Merge a change set with deletes: rows whose ``op_col`` is ``D`` delete
    their key as of their ``order_by`` values, all others are new versions.

    Of equal times the delete wins.  A delete needs no more than key, time and
    partition value; one without key, that could not be matched to anything, is
    left out.  Tombstones lie in ``deleted=true``, in partitions of their own."""
    gone = F.coalesce(F.upper(F.col(op_col)) == "D", F.lit(False))
    rows = events.withColumn(DELETED, gone).drop(op_col).where(~F.col(DELETED) | F.col(key).isNotNull())
    rows = rows.select(*[c for c in rows.columns if c not in (DELETED, partition_col)], DELETED, partition_col)
    return _merge(zone, rows, key, [*order_by, DELETED], [DELETED, partition_col], log_changes)


def live_rows(spark: SparkSession, zone: str) -> DataFrame:
    """The zone without its tombstones (a pruned scan)."""
    return _split(spark, zone, False).drop(DELETED)


def tombstones(spark: SparkSession, zone: str) -> DataFrame:
    """The deleted keys of the zone, each with the time of its delete."""
    return _split(spark, zone, True)


def _split(spark: SparkSession, zone: str, dead: bool) -> DataFrame:
    rows = spark.read.parquet(zone)     # a partition value comes back as text
    flag = F.col(DELETED).cast("boolean")
    return rows.where(flag if dead else ~flag).withColumn(DELETED, flag)


def expire_tombstones(spark: SparkSession, zone: str, before, order_by: str, partition_col: str) -> None:
    """Drop tombstones older than ``before``.  An update older than that which
    comes later still would bring its key back, so ``before`` must lie behind
    the latest arrival to expect."""
    cols = [DELETED, partition_col]
    dead = tombstones(spark, zone)
    old = F.coalesce(F.col(order_by) < F.lit(before), F.lit(True))
    stage = work_dir(spark, "tombstones")
    spots = materialise(dead.where(old).select(*cols).distinct(), f"{stage}/spots")
    places = _small(_renamed(spots, cols))
    kept = dead.join(places, _same(dead, places, cols), "left_semi").where(~old)
    kept = materialise(kept, f"{stage}/kept")
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(zone)
    left = _renamed(kept.select(*cols).distinct(), cols)
    for row in spots.join(left, _same(spots, left, cols), "left_anti").collect():   # at most the partitions
        delete_path(spark, _partition_dir(spark, zone, cols, row))
    delete_path(spark, stage)
