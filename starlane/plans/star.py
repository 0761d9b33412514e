"""The batch star build: raw -> cleaned zone -> dimension zone -> fact zone.

A zone with several consumers is written once as Parquet under the run's
folder, with the columns they read and no others; rows with one consumer are
not written at all.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from starlane.operators.cleaning import clean_bookings
from starlane.operators.dimensions import (
    DIM_SPECS,
    Dimension,
    build_dim_date,
    dimension_from_store,
    dimension_members,
    key_members,
)
from starlane.operators.fact import build_fact
from starlane.operators.masking import masked
from starlane.operators.quality import raw_check_metrics
from starlane.schema import CLEANED_COLS, FACT_COLS, STAR_SCHEMAS
from starlane.session import apply_engine_conf, delete_path, path_exists, work_dir
from starlane.sinks.files import enforce_schema, materialise, write_parquet
from starlane.sources.bookings import raw_bookings
from starlane.streaming.incremental import IncrementalDims


@dataclass
class Star:
    root: str
    cleaned: DataFrame
    raw: DataFrame | None = None
    dims: dict[str, Dimension] = field(default_factory=dict)
    dim_date: DataFrame | None = None
    fact: DataFrame | None = None
    raw_checks: dict[str, int] = field(default_factory=dict)


def cleaned_zone(raw: DataFrame, root: str, columns: list[str] = CLEANED_COLS,
                 raw_checks: dict | None = None) -> DataFrame:
    """Clean and write the cleaned zone.  When ``raw_checks`` is a dict, the
    raw-text quality counts are observed *during the same write* (no second
    pass over the raw feed) and stored in it."""
    if raw_checks is None:
        return materialise(clean_bookings(raw).select(*columns), f"{root}/cleaned")
    obs = Observation("raw_checks")
    observed = raw.observe(obs, *raw_check_metrics(raw))
    zone = materialise(clean_bookings(observed).select(*columns), f"{root}/cleaned")
    raw_checks.update({k: int(v) for k, v in obs.get.items()})
    return zone


def start(spark: SparkSession, sf_dir: str, name: str = "star", columns: list[str] = CLEANED_COLS,
          zone: bool = True, observe_raw: bool = False, raw: DataFrame | None = None) -> Star:
    """Clean the raw feed of ``sf_dir`` (or ``raw``) in a fresh run folder.

    Only ``columns`` are computed and written.  ``zone=False`` writes nothing:
    for a single consumer that reads the rows once."""
    apply_engine_conf(spark)
    root = work_dir(spark, name)
    raw = raw_bookings(spark, sf_dir) if raw is None else raw
    checks: dict | None = {} if observe_raw else None
    cleaned = cleaned_zone(raw, root, columns, checks) if zone else clean_bookings(raw).select(*columns)
    return Star(root, cleaned, raw, raw_checks=checks or {})


def source_columns(names) -> list[str]:
    """Cleaned columns that the members of these dimensions come from."""
    return sorted({c for n in names for c in DIM_SPECS[n][0]})


def add_dims(star: Star, names=tuple(DIM_SPECS)) -> Star:
    """Number the members of the dimensions in ONE pass: one scan of the
    cleaned rows, one distinct over ``(dim, value)``, one range shuffle and
    one key assignment.  The result is the member store ``members/dim=<name>``
    with columns ``sk, value, type, freq``, whatever the number of dimensions.
    """
    names = list(names)
    keyed = key_members(dimension_members(star.cleaned, names, with_freq=True))
    store = materialise(keyed.df, f"{star.root}/members", partition_by=["dim"])
    for n in names:
        star.dims[n] = dimension_from_store(store, n, keyed.group_rows.get(n, 0), keyed.group_bytes.get(n, 0))
    return star


def add_mapped_dims(star: Star, key_map: IncrementalDims) -> Star:
    """As ``add_dims``, with keys that outlive a rebuild (AGG-3).

    ``key_map`` is a durable store of every member ever numbered: known members
    get the number they had, new ones the next, and members that the data no
    longer has keep theirs in the map and are left out of the dimension."""
    names = list(key_map.names)
    spark = star.cleaned.sparkSession
    members = materialise(dimension_members(star.cleaned, names, with_freq=True), f"{star.root}/rebuilt")
    key_map.add(members)
    known = key_map.store(spark)
    if known is None:   # nothing to number yet
        known = spark.createDataFrame([], "sk bigint, value string, type string, dim string")
    kept = members.join(known, ["dim", "value"])    # one row a member on both sides
    store = materialise(kept.select("sk", "value", "type", "freq", "dim"), f"{star.root}/members", partition_by=["dim"])
    sizes = {r["dim"]: (r["n"], r["b"]) for r in store.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("b")).collect()}   # one row a dimension
    for n in names:
        star.dims[n] = dimension_from_store(store, n, *sizes.get(n, (0, 0)))
    return star


def add_dim_date(star: Star) -> Star:
    star.dim_date = build_dim_date(star.cleaned)
    return star


def add_fact(star: Star, columns: list[str] = FACT_COLS, zone: bool = True) -> Star:
    fact = build_fact(star.cleaned, star.dims, columns)
    star.fact = materialise(fact, table_path(star, "fact_booking")) if zone else fact
    return star


def table_path(star: Star, name: str) -> str:
    """Folder of a published star table."""
    return f"{star.root}/{'fact' if name.startswith('fact') else 'dim'}/{name}"


def star_table(star: Star, name: str) -> DataFrame:
    """One of the seven tables, with its declared columns and types."""
    df = {"dim_date": star.dim_date, "fact_booking": star.fact}.get(name)
    if df is None:
        df = star.dims[name].df
    return enforce_schema(df, STAR_SCHEMAS[name])


def publish_dims(star: Star) -> Star:
    """Write every dimension to ``dim/<name>`` with its declared columns."""
    for name in [*star.dims, *(["dim_date"] if star.dim_date is not None else [])]:
        df = materialise(star_table(star, name), table_path(star, name))
        if name == "dim_date":
            star.dim_date = df
        else:
            star.dims[name].df = df
    return star


def build_star(spark: SparkSession, sf_dir: str) -> Star:
    """Full rebuild: every zone is overwritten (keys re-made from scratch)."""
    star = start(spark, sf_dir)
    return add_fact(publish_dims(add_dim_date(add_dims(star))))


# Columns of the published tables that identify a person.
PERSONAL = {"dim_customer": ["customer_id"]}


def publish_masked(star: Star, root: str, salt: str, version: int) -> dict[str, DataFrame]:
    """Write all tables of the star under ``root`` with pseudonyms in place of
    personal identifiers (GOV-1); the plain members stay in the star's folder."""
    names = [*star.dims, *(n for n in ("dim_date", "fact_booking") if
                           {"dim_date": star.dim_date, "fact_booking": star.fact}[n] is not None)]
    return {n: materialise(masked(star_table(star, n), PERSONAL.get(n, []), salt, version), f"{root}/{n}") for n in names}


def land_if_absent(df: DataFrame, target: str, force: bool = False) -> bool:
    """Write ``df`` to ``target`` unless it is already there (SRC-8/SNK-10).

    "There" means committed: a folder without the writer's marker was never
    written whole and is landed again.  The test goes through the Hadoop
    FileSystem API, so it works on any shared store.  Returns whether a write
    happened.
    """
    if not force and path_exists(df.sparkSession, f"{target}/_SUCCESS"):
        return False
    write_parquet(df, target, "overwrite")
    return True


def compact(cleaned: DataFrame, out: str, partition_cols=("year", "month"),
            files: int | None = None) -> None:
    """Re-lay a zone as ``year=/month=`` partitions with about ``files`` files.

    Range partitioning on the partition columns *plus* the booking id keeps
    each task on a contiguous run of months (few files per directory) while
    a month holding a third of all rows is still split over many tasks.
    """
    spark = cleaned.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = cleaned.withColumns({"year": F.year("booking_date"), "month": F.month("booking_date")})
    stage = work_dir(spark, "compact_stage")
    df = materialise(df, stage)     # the range bounds are sampled: the input would be computed twice
    df.repartitionByRange(n, *partition_cols, "booking_id") \
        .write.mode("overwrite").partitionBy(*partition_cols).parquet(out)
    delete_path(spark, stage)


def file_sizes(spark: SparkSession, zone: str, partition_cols: list[str]) -> DataFrame:
    """``*partition_cols, file, size`` of every file of a zone (a scan of the
    files' footers: no column is read)."""
    return spark.read.parquet(zone).select(
        *partition_cols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()


def compact_small_files(spark: SparkSession, zone: str, partition_cols: list[str],
                        target_bytes: int = 128 * 1024 * 1024, min_files: int = 4) -> int:
    """Rewrite the partitions of a zone that have at least ``min_files`` files
    below half of ``target_bytes`` (LAY-1); how many there were.

    The files of such a partition, in order of name, are packed into bins of
    about ``target_bytes``; the rows of a bin become one file, so a large
    partition is the work of many tasks.  Rows move once: the dynamic overwrite
    stages the new files whole beside the partitions that they are read from,
    and its commit swaps them in; all other partitions keep their files."""
    stage = work_dir(spark, "compact_small")
    sizes = materialise(file_sizes(spark, zone, partition_cols), f"{stage}/sizes")
    small = F.count(F.when(F.col("size") < target_bytes // 2, 1))
    chosen = sizes.groupBy(*partition_cols).agg(small.alias("small")).where(F.col("small") >= min_files)
    chosen = materialise(chosen.select(*[F.col(c).alias(f"_c_{c}") for c in partition_cols]), f"{stage}/chosen")
    n = chosen.count()
    if not n:
        delete_path(spark, stage)
        return 0
    same = None
    for c in partition_cols:
        one = F.col(c).eqNullSafe(F.col(f"_c_{c}"))
        same = one if same is None else same & one
    # a row a file: small beside what the files hold
    before = Window.partitionBy(*partition_cols).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("size").over(before), F.lit(0))
    bins = sizes.join(chosen, same, "left_semi").select(
        F.col("file").alias("_file"), F.floor(filled / target_bytes).cast("int").alias("_bin"))
    bins = materialise(bins, f"{stage}/bins")
    rows = spark.read.parquet(zone).withColumn("_from", F.col("_metadata.file_path"))
    rows = rows.join(bins, F.col("_from") == F.col("_file")).drop("_from", "_file")
    rows.repartition(*partition_cols, "_bin").drop("_bin") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols).parquet(zone)
    delete_path(spark, stage)
    return n
