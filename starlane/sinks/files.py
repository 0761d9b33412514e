"""File and table sinks (SNK-1..12).

All writes are Spark writers: sharded by default, one file only when asked
(``single_file=True`` adds ``coalesce(1)``, which funnels the table through
one task - acceptable for a small dimension, never the default for a fact).
Row counts for logs come from ``DataFrame.observe`` on the write itself, not
from a second job.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("starlane.sinks")

CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',             # RFC 4180: a quote inside a field is doubled
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",           # NULL is an empty field (never the text 'None')
}
# a lone carriage return is part of a value, never the end of a row
CSV_READ_OPTIONS = {"header": "true", "escape": '"', "mode": "PERMISSIVE", "lineSep": "\n"}


def _maybe_single(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              columns: list[str] | None = None, single_file: bool = False,
              skip_empty: bool = False, partition_by: list[str] | None = None) -> int | None:
    """Write CSV; returns the row count observed during the write.

    ``columns`` fixes the column order (SNK-2); ``skip_empty`` skips writing a
    table with no rows (SNK-3; the emptiness test reads one row at most).
    """
    if columns:
        df = df.select(*columns)
    if skip_empty and df.isEmpty():
        log.info("Skipping empty output %s", path)
        return 0
    obs = Observation("csv_rows")
    observed = _maybe_single(df, single_file).observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode).options(**CSV_WRITE_OPTIONS).option("header", str(header).lower())
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    rows = obs.get.get("rows")
    log.info("Wrote %s rows to %s", rows, path)
    return rows


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             header: bool = True, multi_line: bool = False,
             corrupt_column: str | None = None) -> DataFrame:
    """RFC-style CSV scan (SRC-1..3).

    With a ``schema`` no inference pass runs, and a file whose header has other
    names, or the same in another order, stops the job (Spark would map the
    columns by position; ``read_csv_by_name`` maps them); without one it is
    inferred (one extra pass - avoid on large inputs).  ``corrupt_column``
    keeps ragged rows (short rows padded with NULL, long rows cut) and flags
    them in that column.  ``multi_line`` accepts quoted newlines but makes
    each file one split, so it is opt-in.
    """
    r = spark.read.options(**CSV_READ_OPTIONS).option("header", str(header).lower())
    if multi_line:
        r = r.option("multiLine", "true")
    if schema is not None:
        if corrupt_column:
            st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
            schema = st.add(corrupt_column, T.StringType())
            r = r.option("columnNameOfCorruptRecord", corrupt_column)
        r = r.schema(schema).option("enforceSchema", "false")
    else:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def read_csv_by_name(spark: SparkSession, files: list[str] | DataFrame, columns: list[str], required: list[str],
                     logical=None) -> DataFrame:
    """Text columns of CSV files, mapped by header name whatever their order.

    ``files`` are paths (folders too) or an inventory of files.  ``logical``
    maps a frame with a file's own headers to logical names; files of equal
    headers are read together.  A missing column is NULL, a missing ``required``
    one raises.  The headers come from one distributed scan (``file_inventory``);
    the driver opens no file."""
    from starlane.sources.inventory import file_inventory, files_by_header

    if isinstance(files, list):
        files = file_inventory(spark, files) if files else None
    parts = []
    for header, members in files_by_header(files) if files is not None else []:
        schema = T.StructType([T.StructField(h, T.StringType(), True) for h in header])
        df = read_csv(spark, members, schema=schema)
        df = logical(df) if logical else df
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"{members[0]}: required columns missing: {missing}")
        parts.append(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                                 for c in columns]))
    out = parts[0] if parts else spark.createDataFrame(
        [], T.StructType([T.StructField(c, T.StringType(), True) for c in columns]))
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def parse_lines(lines: DataFrame, schema: T.StructType | str, column: str = "value",
                header_line: str | None = None) -> DataFrame:
    """Split already-read text lines into typed columns with ``from_csv``
    (SRC-2 when the feed arrives as lines, e.g. ``spark.read.text``).

    ``header_line`` drops lines equal to the header text (each file of a
    headered feed starts with it).  Quotes follow RFC 4180; a line with too
    few fields gives NULLs in the missing columns.
    """
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    src = lines if header_line is None else lines.where(F.col(column) != header_line)
    parsed = src.select(F.from_csv(F.col(column), st.simpleString(),
                                   {"escape": '"', "mode": "PERMISSIVE"}).alias("_r"))
    return parsed.select("_r.*")


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None, single_file: bool = False,
                  count: bool = False) -> int | None:
    """Parquet write (SNK-4/5, SNK-10, LAY-1); with ``count`` returns the row
    count observed during the write (AGG-10)."""
    if count:
        obs = Observation("parquet_rows")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = _maybe_single(df, single_file).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if not count:
        return None
    rows = obs.get.get("rows")
    log.info("Wrote %s rows to %s", rows, path)
    return rows


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a zone as Parquet and return a frame reading it back.

    This cuts lineage: consumers re-read files in the shared folder instead
    of recomputing (and a lost executor costs a file re-read, not a rebuild).
    """
    write_parquet(df, path, "overwrite", partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)     # an empty zone has no schema of its own


def enforce_schema(df: DataFrame, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Select the declared columns in order and cast each to its type (SNK-8).

    Missing columns raise when ``strict`` (else become typed NULLs); casts are
    ``try_cast`` so a bad value is NULL instead of a failed job
    (``lost_values`` counts those).
    """
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    missing = [f.name for f in st.fields if f.name not in df.columns]
    if missing and strict:
        raise ValueError(f"missing columns for declared schema: {missing}")
    cols = []
    for f in st.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def lost_values(df: DataFrame, schema: T.StructType | str) -> Column:
    """Aggregate: values that ``enforce_schema`` would turn into NULL."""
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    lost = F.lit(0).cast("bigint")
    for f in st.fields:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            c = F.col(f.name)
            lost = lost + F.count(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), 1))
    return lost.alias("lost_values")


def rejected_reasons(df: DataFrame, schema: T.StructType | str, required: list[str] = ()) -> Column:
    """``array<string>``: why a row does not fit the declared schema, one
    ``<column>: <reason>`` a fault; empty for a row that does."""
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    faults = []
    for f in st.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if df.schema[f.name].dataType != f.dataType:
            kind = f.dataType.simpleString()
            faults.append(F.when(c.isNotNull() & c.try_cast(f.dataType).isNull(), F.lit(f"{f.name}: not {kind}")))
        if f.name in required:
            faults.append(F.when(c.isNull(), F.lit(f"{f.name}: missing")))
    return F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")


@dataclass
class Checked:
    """What ``write_checked`` wrote: rows that fit, rows that do not, counts."""
    kept: DataFrame
    rejected: DataFrame
    rows: int
    rejected_rows: int


def write_checked(df: DataFrame, path: str, schema: T.StructType | str, required: list[str] = ()) -> Checked:
    """Write ``df`` with its declared schema, rows that lose a value (or lack a
    required one) set apart with the reasons and their source text (SNK-8).

    One pass: the two kinds are partitions of one write, ``rejected=false`` and
    ``rejected=true``, so no row is judged twice and none is in both or
    neither.  ``rejected`` has the row as it came, as JSON in ``source``, the
    columns that can be cast, and ``reasons``."""
    spark = df.sparkSession
    st = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    clash = {"reasons", "source", "rejected"} & {f.name.lower() for f in st.fields}
    if clash:
        raise ValueError(f"columns of the schema clash with those of the side table: {sorted(clash)}")
    names = [f.name for f in st.fields]
    judged = df.withColumn("_reasons", rejected_reasons(df, st, required))
    source = F.when(F.size("_reasons") > 0, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    typed = enforce_schema(judged.withColumn("_source", source), T.StructType(
        [*st.fields, T.StructField("_reasons", T.ArrayType(T.StringType())), T.StructField("_source", T.StringType())]))
    out = typed.select(*names, F.col("_reasons").alias("reasons"), F.col("_source").alias("source"),
                       (F.size("_reasons") > 0).alias("rejected"))
    obs = Observation("checked_rows")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("rejected"), 1)).alias("bad"))
    write_parquet(out, path, partition_by=["rejected"])
    counts = obs.get
    back = spark.read.schema(out.schema).parquet(path)
    log.info("Wrote %s rows to %s, %s of them rejected", counts["rows"], path, counts["bad"])
    return Checked(back.where(~F.col("rejected")).select(*names), back.where("rejected").drop("rejected"),
                   int(counts["rows"]), int(counts["bad"]))


def declared_schema(spec: str) -> T.StructType:
    """Parse a ``"name:TYPE,name:TYPE"`` declaration into a StructType."""
    fields = []
    for part in spec.split(","):
        name, typ = part.strip().split(":")
        fields.append(f"`{name.strip()}` {typ.strip()}")
    return T.StructType.fromDDL(", ".join(fields))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (SNK-9)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def write_table(df: DataFrame, table: str, mode: str = "overwrite",
                schema: T.StructType | str | None = None) -> dict[str, int]:
    """Managed-table write, create if needed; ``overwrite`` truncates (SNK-6),
    ``append`` adds (SNK-7).  A declared schema is enforced first, and an
    append into an existing table must match its schema exactly.  Returns
    ``rows`` and ``lost_values``, observed during the write."""
    spark = df.sparkSession
    obs = Observation("table_rows")
    lost = lost_values(df, schema) if schema is not None else F.lit(0).cast("bigint").alias("lost_values")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"), lost)
    if schema is not None:
        df = enforce_schema(df, schema)
    if mode == "append" and spark.catalog.tableExists(table):
        existing = spark.table(table).schema
        if [(f.name, f.dataType) for f in existing] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"schema of {table} differs from the appended frame")
    df.write.mode(mode).format("parquet").saveAsTable(table)
    counts = {k: int(v) for k, v in obs.get.items()}
    log.info("Wrote %s to %s", counts, table)
    return counts


def append_once(df: DataFrame, table: str, write_id: str, schema: T.StructType | str | None = None) -> dict[str, int]:
    """Append under a write id: a replay under the same id replaces what the
    first attempt wrote, so every row is there once (SNK-7).

    The table is partitioned by ``write_id``; an append overwrites that
    partition alone, and an attempt that breaks off before its commit leaves
    the table as it was.  An id given with other rows replaces its rows; given with
    none, it changes nothing."""
    spark = df.sparkSession
    if not write_id:
        raise ValueError("append_once needs a write id")
    obs = Observation("once_rows")
    lost = lost_values(df, schema) if schema is not None else F.lit(0).cast("bigint").alias("lost_values")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"), lost)
    if schema is not None:
        df = enforce_schema(df, schema)
    kinds = [(f.name, f.dataType) for f in df.schema]
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], T.StructType([*df.schema.fields, T.StructField("write_id", T.StringType())]))
        empty.write.mode("ignore").format("parquet").partitionBy("write_id").saveAsTable(table)
    existing = [(f.name, f.dataType) for f in spark.table(table).schema]
    if existing != [*kinds, ("write_id", T.StringType())]:
        raise ValueError(f"schema of {table} differs from the appended frame, or it has no write ids")
    # dynamic: the new files are written beside the old ones and swapped in at
    # the commit; a write into a table takes the mode from the session alone
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.withColumn("write_id", F.lit(write_id)).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    counts = {k: int(v) for k, v in obs.get.items()}
    log.info("Wrote %s to %s under %s", counts, table, write_id)
    return counts


def csv_line(df: DataFrame, columns: list[str], sep: str = ",") -> DataFrame:
    """One CSV text line per row (SNK-11), NULL rendered as an empty field."""
    return df.select(F.to_csv(F.struct(*columns), {"sep": sep, "nullValue": ""}).alias("line"))
