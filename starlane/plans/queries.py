"""Registered queries: one per operator group of the bookings ETL.

Every query reads the driver's tables under ``sf_dir`` (through the raw
bookings feed derived from them), runs over all rows, and returns a lazy
DataFrame.  Zone writes and key checkpoints happen inside, in a fresh folder
under the session's shared checkpoint directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.functions.numeric import safe_int
from starlane.functions.text import normalise_headers
from starlane.functions.time import parse_formats
from starlane.operators import cdc, kpi, kpi_state, quality, quality_state, sorts
from starlane.operators.cleaning import clean_bookings, filtered_distinct, with_normalised_headers
from starlane.operators.dimensions import Dimension, build_dim_date, reason_sources
from starlane.operators.fact import LOOKUPS, apply_lookups
from starlane.operators.masking import mask_ids, rotate, rotation_map
from starlane.plans import star as S
from starlane.schema import (
    CLEANED_COLS,
    CLEANED_SCHEMA,
    FACT_COLS,
    RAW_HEADERS,
    REQUIRED_COLS,
    SOURCE_COLS,
    STAR_SCHEMAS,
)
from starlane.session import apply_engine_conf, delete_path, work_dir
from starlane.sinks import files as sinks
from starlane.sources.bookings import raw_bookings, table
from starlane.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
RAW_NAMES = normalise_headers(RAW_HEADERS)


def _raw(spark, sf_dir) -> DataFrame:
    apply_engine_conf(spark)
    return raw_bookings(spark, sf_dir)


def _cleaned(spark, sf_dir) -> DataFrame:
    return clean_bookings(_raw(spark, sf_dir))


# ---- projections, scans and sinks -------------------------------------------

def clean_headers_project(spark, sf_dir):
    return with_normalised_headers(_raw(spark, sf_dir)).select(*RAW_NAMES)


def _files(spark, path: str, suffix: str = ".csv") -> list[str]:
    """Data files directly under a folder, through the Hadoop API."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [str(f.getPath().toString()) for f in fs.listStatus(p)]
    return sorted(f for f in found if f.endswith(suffix))


def csv_roundtrip_scan(spark, sf_dir):
    """Raw feed -> headered CSV (fixed column order) -> scan by header name."""
    path = work_dir(spark, "csv_roundtrip") + "/raw_csv"
    raw = with_normalised_headers(_raw(spark, sf_dir))
    sinks.write_csv(raw, path, columns=RAW_NAMES, skip_empty=True)
    return sinks.read_csv_by_name(spark, _files(spark, path), RAW_NAMES, REQUIRED_COLS, with_normalised_headers)


def csv_ragged_rows(spark, sf_dir):
    """Lines of a delimited feed of which some lack their last field and some
    have one too many: every row is kept, and the ragged ones are flagged."""
    path = work_dir(spark, "csv_ragged") + "/lines"
    rows = _cleaned(spark, sf_dir).select("booking_id", "customer_id", "vehicle_type")
    kind = F.pmod(F.length("customer_id") + F.length("booking_id"), F.lit(3))
    cells = [F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in rows.columns]
    fields = F.when(kind == 0, F.array(*cells[:2])).when(kind == 1, F.array(*cells, F.lit("more"))).otherwise(F.array(*cells))
    rows.select(F.concat_ws(",", fields)).write.text(path)
    schema = "booking_id string, customer_id string, vehicle_type string"
    read = sinks.read_csv(spark, path, schema=schema, header=False, corrupt_column="line")
    return read.select("booking_id", "customer_id", "vehicle_type", F.col("line").isNotNull().alias("ragged"))


def csv_external_autodetect(spark, sf_dir):
    """Raw CSV with the original headers as an external table with inferred
    types (``inferSchema``, quoted newlines allowed), then cleaned."""
    root = work_dir(spark, "csv_external")
    sinks.write_csv(_raw(spark, sf_dir), f"{root}/raw_csv")
    name = f"raw_bookings_ext_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE TABLE {name} USING csv OPTIONS (path '{root}/raw_csv', header 'true', "
              f"inferSchema 'true', multiLine 'true', escape '\"')")
    cleaned = clean_bookings(spark.table(name)).select(*CLEANED_COLS)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay, and the frame reads them
    return cleaned


def _cleaned_view(spark, sf_dir, tag: str) -> str:
    """The saved view over the cleaned zone: ``SELECT DISTINCT *`` of a glob."""
    root = work_dir(spark, tag)
    sinks.write_parquet(_cleaned(spark, sf_dir), f"{root}/cleaned")
    view = f"vw_cleaned_trips_{root.rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {view} AS "
              f"SELECT DISTINCT * FROM parquet.`{root}/cleaned/*.parquet`")
    return view


def parquet_zone_view(spark, sf_dir):
    """Cleaned zone -> glob scan -> ``SELECT DISTINCT *`` view -> first 100
    rows of the view in order."""
    view = spark.table(_cleaned_view(spark, sf_dir, "zone_view"))
    return sorts.head_in_full_order(view, 100)


def cleaned_filtered_distinct(spark, sf_dir):
    """The cleaned step's null and value filters, read through the view."""
    return filtered_distinct(spark.table(_cleaned_view(spark, sf_dir, "filtered"))).select(*CLEANED_COLS)


def land_raw_if_absent(spark, sf_dir):
    """Land the raw feed in the raw zone once; a second call is a no-op."""
    target = work_dir(spark, "landing") + "/raw"
    raw = with_normalised_headers(_raw(spark, sf_dir))
    for _ in range(2):
        S.land_if_absent(raw, target)
    return spark.read.parquet(target).select(*RAW_NAMES)


def table_sinks(spark, sf_dir):
    """Declared-schema table writes: overwrite (truncate) twice, then append
    two disjoint parts; the table holds every fact row exactly once."""
    st = S.add_fact(S.add_dims(S.start(spark, sf_dir, "tables")))
    db = f"starlane_{st.root.rsplit('-', 1)[-1]}"
    sinks.ensure_database(spark, db, f"{st.root}/warehouse")
    decl = sinks.declared_schema(",".join(
        f"{f.name}:{f.dataType.simpleString()}" for f in STAR_SCHEMAS["fact_booking"].fields))
    tbl = f"{db}.fact_booking"
    sinks.write_table(st.fact, tbl, "overwrite", decl)
    sinks.write_table(st.fact, tbl, "overwrite", decl)
    sinks.write_table(st.fact.where(F.col("date_id").isNull()), f"{db}.fact_append",
                      "append", decl)
    sinks.write_table(st.fact.where(F.col("date_id").isNotNull()), f"{db}.fact_append",
                      "append", decl)
    a = spark.table(tbl).withColumn("table_mode", F.lit("overwrite"))
    b = spark.table(f"{db}.fact_append").withColumn("table_mode", F.lit("append"))
    out = sinks.materialise(a.unionByName(b).select("table_mode", *FACT_COLS), f"{st.root}/result")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def append_exactly_once(spark, sf_dir):
    """Cleaned rows appended in three parts, every part twice (once more after
    the others, as a job that starts over does); the table has each row once."""
    root = work_dir(spark, "append_once")
    # a partition of the zone for each part, so an append reads its own rows alone
    rest = F.coalesce(F.col("date_id") % 3, F.lit(0)).alias("rest")
    rows = sinks.materialise(_cleaned(spark, sf_dir).select(*CLEANED_COLS, rest), f"{root}/cleaned", ["rest"])
    db = f"starlane_{root.rsplit('-', 1)[-1]}"
    sinks.ensure_database(spark, db, f"{root}/warehouse")
    for k in (0, 1, 1, 2, 0, 2):
        part = rows.where(F.col("rest") == k).select(*CLEANED_COLS)
        sinks.append_once(part, f"{db}.bookings", f"day-rest-{k}", CLEANED_SCHEMA)
    out = sinks.materialise(spark.table(f"{db}.bookings").select(*CLEANED_COLS), f"{root}/result")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


# types that the raw feed is checked against before it is cleaned
FEED_TYPES = ("booking_id string, customer_id string, date string, time string, avg_vtat double, avg_ctat double, "
              "booking_value decimal(18,2), ride_distance double, driver_ratings int, customer_rating int")


def quarantine_feed(spark, sf_dir):
    """The raw feed against its declared types: rows that fit, and rows set
    apart with the reasons and the text that did not fit."""
    raw = with_normalised_headers(_raw(spark, sf_dir))
    feed = raw.select("booking_id", "customer_id", "date", "time", "avg_vtat", "avg_ctat", "booking_value",
                      "ride_distance", "driver_ratings", "customer_rating")
    done = sinks.write_checked(feed, work_dir(spark, "quarantine") + "/feed", FEED_TYPES, required=["time"])
    text = F.get_json_object("source", "$.booking_value")
    kept = done.kept.select("booking_id", F.lit("kept").alias("part"), F.col("booking_value").cast("string").alias("value"),
                            F.lit("").alias("reasons"))
    bad = done.rejected.select("booking_id", F.lit("rejected").alias("part"), text.alias("value"),
                               F.concat_ws("; ", "reasons").alias("reasons"))
    return kept.unionByName(bad).withColumns({"rows": F.lit(done.rows).cast("bigint"),
                                              "rejected_rows": F.lit(done.rejected_rows).cast("bigint")})


# What the export queries return of each of the seven tables: a number and a text.
EXPORTED = {
    "dim_date": ("date_id", "day_of_week"), "dim_customer": ("customer_sk", "customer_id"),
    "dim_vehicle": ("vehicle_sk", "vehicle_type"), "dim_location": ("location_sk", "location_name"),
    "dim_payment": ("payment_sk", "payment_method"), "dim_reason": ("reason_sk", "reason_text"),
    "fact_booking": ("date_id", "booking_id"),
}


def _exported(tables: dict[str, DataFrame], **extra) -> DataFrame:
    out = None
    for name, df in tables.items():
        key, label = EXPORTED[name]
        part = df.select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("k"),
                         F.col(label).cast("string").alias("v"),
                         *[F.lit(v).alias(n) for n, v in extra.items()])
        out = part if out is None else out.unionByName(part)
    return out


def _whole_star(spark, sf_dir, name) -> S.Star:
    return S.add_fact(S.add_dim_date(S.add_dims(S.start(spark, sf_dir, name))))


def star_tables(spark, sf_dir):
    """All seven tables with their declared schemas: overwritten twice, then
    the dimensions and the fact appended to a second set of tables."""
    st = _whole_star(spark, sf_dir, "star_tables")
    db = f"starlane_{st.root.rsplit('-', 1)[-1]}"
    sinks.ensure_database(spark, db, f"{st.root}/warehouse")
    out = None
    for mode, times in (("overwrite", 2), ("append", 1)):
        tables = {}
        for name, schema in STAR_SCHEMAS.items():
            for _ in range(times):
                sinks.write_table(S.star_table(st, name), f"{db}.{mode}_{name}", mode, schema)
            tables[name] = spark.table(f"{db}.{mode}_{name}")
        part = _exported(tables, table_mode=mode)
        out = part if out is None else out.unionByName(part)
    out = sinks.materialise(out, f"{st.root}/result")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def star_csv_export(spark, sf_dir):
    """All seven tables as headered CSV (an empty one is skipped), the date
    dimension in ``date_id`` order; read back by name, with the row counts
    that the writes observed."""
    st = _whole_star(spark, sf_dir, "star_csv")
    out = None
    for name, schema in STAR_SCHEMAS.items():
        df, path = S.star_table(st, name), f"{st.root}/csv/{name}"
        if name == "dim_date":
            df = df.orderBy("date_id")
        rows = sinks.write_csv(df, path, columns=schema.fieldNames(), skip_empty=True)
        if rows:
            back = sinks.read_csv_by_name(spark, _files(spark, path), schema.fieldNames(), schema.fieldNames())
            part = _exported({name: sinks.enforce_schema(back, schema)}, rows_written=rows)
            out = part if out is None else out.unionByName(part)
    return out


def cleaned_csv(spark, sf_dir):
    """The cleaned rows as CSV in the fixed column order, read back."""
    path = work_dir(spark, "cleaned_csv") + "/cleaned"
    sinks.write_csv(_cleaned(spark, sf_dir), path, columns=CLEANED_COLS)
    return sinks.read_csv(spark, path, schema=CLEANED_SCHEMA)


def single_file_exports(spark, sf_dir):
    """A small dimension as one headerless CSV file and as one Parquet file,
    and as CSV text lines parsed again."""
    st = S.add_dims(S.start(spark, sf_dir, "single", S.source_columns(["dim_vehicle"]), zone=False), ["dim_vehicle"])
    dim, schema = S.star_table(st, "dim_vehicle"), STAR_SCHEMAS["dim_vehicle"]
    sinks.write_csv(dim, f"{st.root}/csv", header=False, single_file=True)
    sinks.write_parquet(dim, f"{st.root}/parquet", single_file=True)
    lines = sinks.csv_line(dim, schema.fieldNames()).withColumnRenamed("line", "value")
    forms = {"csv": sinks.read_csv(spark, f"{st.root}/csv", schema=schema, header=False),
             "parquet": spark.read.parquet(f"{st.root}/parquet"),
             "lines": sinks.parse_lines(lines, schema)}
    files = {n: len(_files(spark, f"{st.root}/{n}", f".{n}")) for n in ("csv", "parquet")}
    out = None
    for form, df in forms.items():
        part = df.select(F.lit(form).alias("form"), F.lit(files.get(form, 0)).alias("files"), *schema.fieldNames())
        out = part if out is None else out.unionByName(part)
    return out


# ---- column functions -------------------------------------------------------

def parse_timestamp_date_id(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("booking_id", "date", "time", "booking_timestamp",
                                          "booking_date", "date_id")


def parse_timestamp_formats(spark, sf_dir):
    """Order dates written in five formats by turns, parsed by a format list."""
    shapes = ["yyyy-M-d", "yyyy/M/d", "dd-MM-yyyy", "d/M/yyyy", "yyyyMMdd", "MMM d yyyy"]
    orders = table(spark, sf_dir, "orders").withColumn("n", F.pmod("o_orderkey", F.lit(len(shapes))))
    text = F.coalesce(*[F.when(F.col("n") == i, F.date_format("o_orderdate", f)) for i, f in enumerate(shapes)])
    time = F.concat_ws(":", F.pmod("o_orderkey", F.lit(25)).cast("string"), F.lit("5"), F.lit("07"))
    rows = orders.select("o_orderkey", text.alias("date"), time.alias("time"))
    formats = ["yyyy-M-d", "yyyy/M/d", "d-M-yyyy", "d/M/yyyy", "yyyyMMdd"]
    return rows.select("o_orderkey", "date", "time", parse_formats("date", "time", formats).alias("ts"),
                       parse_formats("date", None, formats).alias("day"))


def date_only_feed(spark, sf_dir):
    """A feed without time column, with an alias beside the logical reason
    column and ids as padded text: midnight, falsy coalesce, guarded int."""
    raw = _raw(spark, sf_dir)
    feed = raw.drop("Time").withColumnsRenamed({"Driver Cancellation Reason": "Reason for cancelling"})
    out = clean_bookings(feed).select("booking_id", "booking_timestamp", "date_id",
                                      "reason_for_cancelling_by_customer", "driver_cancellation_reason")
    number = F.concat(F.lit("\t"), F.substring_index("booking_id", "-", 1), F.lit(" "))
    return out.withColumn("order_number", safe_int(number))


def title_trim_status(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("booking_id", "booking_status", "vehicle_type",
                                          "pickup_location", "drop_location")


def map_payment(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("booking_id", "payment_method")


def strip_quotes_ids(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("booking_id", "customer_id")


def safe_measures(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("booking_id", "avg_vtat", "avg_ctat", "booking_value",
                                          "ride_distance", "driver_ratings", "customer_rating")


# ---- dimensions ---------------------------------------------------------------

def _dims_of(spark, sf_dir, names: list[str]) -> S.Star:
    """Dimensions alone: one consumer, so the cleaned rows are not written."""
    return S.add_dims(S.start(spark, sf_dir, "dims", S.source_columns(names), zone=False), names)


def _dim_query(name: str) -> Query:
    def q(spark, sf_dir):
        return S.star_table(_dims_of(spark, sf_dir, [name]), name)
    q.__name__ = name
    return q


def dim_date(spark, sf_dir):
    st = S.start(spark, sf_dir, "dim_date", ["booking_date", "date_id"], zone=False)
    return build_dim_date(st.cleaned).orderBy("date_id")


def dim_reason_source(spark, sf_dir):
    """Reasons with the columns they come from beside the type by wording."""
    st = S.add_dims(S.start(spark, sf_dir, "reasons", S.source_columns(["dim_reason"])), ["dim_reason"])
    return reason_sources(st.cleaned, st.dims["dim_reason"]).select("reason_sk", "reason_text", "type", "source_type")


def distinct_pairs(spark, sf_dir):
    return _cleaned(spark, sf_dir).select("customer_id", "pickup_location").distinct()


# ---- lookups and the fact -------------------------------------------------------

def _looked_up(spark, sf_dir, dim: str, keep: list[str]) -> DataFrame:
    """Every lookup of one dimension; its members and the lookups read the
    same written columns."""
    columns = sorted({"booking_id", *S.source_columns([dim])})
    st = S.add_dims(S.start(spark, sf_dir, "lookup", columns), [dim])
    return apply_lookups(st.cleaned, st.dims, [x for x in LOOKUPS if x[0] == dim]).select(*keep)


def lookup_single(spark, sf_dir):
    return _looked_up(spark, sf_dir, "dim_customer", ["booking_id", "customer_id", "customer_sk"])


def lookup_role_playing(spark, sf_dir):
    return _looked_up(spark, sf_dir, "dim_location", ["booking_id", "pickup_location", "drop_location",
                                                      "pickup_location_sk", "drop_location_sk"])


def lookup_sparse_reason(spark, sf_dir):
    return _looked_up(spark, sf_dir, "dim_reason", ["booking_id", "customer_cancel_reason_sk",
                                                    "driver_cancel_reason_sk", "incomplete_reason_sk"])


def fact_booking(spark, sf_dir):
    """The fact as a lazy frame over the zones its consumers would share."""
    st = S.add_dims(S.start(spark, sf_dir, "fact", [c for c in CLEANED_COLS if c not in
                                                    ("date", "time", "booking_timestamp", "booking_date")]))
    return S.add_fact(st).fact


# ---- KPIs and quality ------------------------------------------------------------

def _kpi(fn) -> Query:
    """A KPI over the dimensions and fact columns it declares; the fact has
    one consumer and is not written."""
    def q(spark, sf_dir):
        dims = kpi.KPI_DIMS[fn.__name__]
        measures = kpi.KPI_COLUMNS[fn.__name__]
        columns = sorted({*S.source_columns(dims), *measures})
        st = S.add_dims(S.start(spark, sf_dir, fn.__name__, columns), dims)
        keys = [fk for d, c, fk in LOOKUPS if d in dims]
        S.add_fact(st, [*keys, *measures], zone=False)
        return fn(st.fact, st.dims)
    q.__name__ = fn.__name__
    return q


def dq_report(spark, sf_dir):
    """All data-quality checks; the raw-text checks are observed while the
    cleaned zone is written, so the raw feed is read once."""
    st = S.add_fact(S.add_dims(S.start(spark, sf_dir, "dq", observe_raw=True)))
    return quality.dq_report(st.cleaned, st.fact, st.dims, st.raw, st.raw_checks)


def dq_report_broken_feed(spark, sf_dir):
    """Every check on a feed that lacks two columns, with a dimension in which
    some members occur twice."""
    feed = _raw(spark, sf_dir).drop("Ride Distance", "Customer Rating")
    st = S.add_fact(S.add_dims(S.start(spark, sf_dir, "dq_broken", observe_raw=True, raw=feed)))
    d = st.dims["dim_vehicle"]
    again = d.df.where(F.col("vehicle_sk") % 10 == 0)
    st.dims["dim_vehicle"] = Dimension(d.name, d.df.unionByName(again), d.nk, d.sk, d.rows, d.key_bytes, unique=False)
    return quality.dq_report(st.cleaned, st.fact, st.dims, st.raw, st.raw_checks)


def daily_anomalies(spark, sf_dir):
    """Needs two columns of the cleaned rows and no lookup."""
    return quality.daily_anomalies(S.start(spark, sf_dir, "anomalies", ["date_id", "booking_value"], zone=False).cleaned)


# ---- CDC, incremental, streaming ------------------------------------------------

def cdc_latest_per_key(spark, sf_dir):
    return cdc.latest_per_key(_cleaned(spark, sf_dir).select(*CLEANED_COLS), "booking_id", ["booking_timestamp"])


def _change_sets(spark, sf_dir, name: str, columns: list[str]) -> tuple[str, list]:
    """The cleaned rows as arrival batches, written once, partitioned by
    booking year (rows without a date come last); (folder, batch numbers)."""
    root = work_dir(spark, name)
    rows = _cleaned(spark, sf_dir).withColumn("batch", F.coalesce(F.year("booking_date"), F.lit(99999)))
    sinks.materialise(rows.select(*columns, "batch"), f"{root}/changes", partition_by=["batch"])
    # a calendar-sized list, from the partitions alone
    batches = spark.read.parquet(f"{root}/changes").select("batch").distinct().orderBy("batch").collect()
    return root, [r["batch"] for r in batches]


def _change_set(spark, root: str, batch: int) -> DataFrame:
    return spark.read.parquet(f"{root}/changes").where(F.col("batch") == batch).drop("batch")


def cdc_upsert_zone(spark, sf_dir):
    """Apply the cleaned rows as yearly change sets, each one twice, to a
    month-partitioned zone with last-write-wins upserts; the end state is the
    latest row per key, and rows without key once for each time they came."""
    root, batches = _change_sets(spark, sf_dir, "cdc_upsert", CLEANED_COLS)
    target = f"{root}/bookings_by_month"
    for batch in batches:
        changes = _change_set(spark, root, batch).withColumns({
            # the feed has no row without id, so some lose it here
            "booking_id": F.when(~F.col("booking_id").endswith("0-4"), F.col("booking_id")),
            "month": (F.col("date_id") / 100).cast("int")})
        for _ in range(2):
            cdc.upsert_latest(target, changes, "booking_id", ["booking_timestamp"], "month")
    return spark.read.parquet(target).select(*CLEANED_COLS)


def _order_events(spark, sf_dir, name: str) -> tuple[str, list[int]]:
    """Change events per order, written once as three arrival batches that
    are not in time order; (folder, batches as they arrive).

    Each line of an order is a version of it; second lines also give a delete
    half a day later, with no more than key and time."""
    root = work_dir(spark, name)
    line = F.col("booking_id")
    rows = _cleaned(spark, sf_dir).select(*CLEANED_COLS)
    # one pass: a second line is its own version and a delete
    ops = F.when(line.endswith("-2"), F.array(F.lit("U"), F.lit("D"))).otherwise(F.array(F.lit("U")))
    later = F.col("booking_timestamp") + F.expr("INTERVAL 12 HOURS")
    gone = F.col("op") == "D"
    own = {"booking_id": F.substring_index(line, "-", 1),
           "booking_timestamp": F.when(gone, later).otherwise(F.col("booking_timestamp"))}
    events = rows.withColumn("op", F.explode(ops)).select(
        *[own.get(c, F.when(~gone, F.col(c))).alias(c) for c in CLEANED_COLS], "op")
    month = F.year("booking_timestamp") * 100 + F.month("booking_timestamp")
    events = events.withColumn("month", month.cast("int")).withColumn("batch", F.coalesce(F.col("month") % 3, F.lit(0)))
    sinks.materialise(events, f"{root}/changes", partition_by=["batch"])
    return root, [2, 0, 1]


def _apply_order_events(spark, sf_dir, name: str, each=None) -> str:
    """The zone after all batches; without ``each``, the second arrives twice."""
    root, batches = _order_events(spark, sf_dir, name)
    zone = f"{root}/orders"
    arriving = batches if each else [*batches[:2], *batches[1:]]
    for k, batch in enumerate(arriving):
        cdc.apply_changes(zone, _change_set(spark, root, batch), "booking_id", ["booking_timestamp"], "month",
                          log_changes=each is not None)
        if each:
            each(zone)
        if batch not in arriving[k + 1:]:
            delete_path(spark, f"{root}/changes/batch={batch}")     # merged; what is left is the zone
    return zone


def _refreshed(refresh, spark, zone: str, state: str) -> None:
    """A refresh, after which no reader needs the differences before it."""
    cdc.forget_differences(spark, zone, refresh(spark, zone, state))


def cdc_deletes(spark, sf_dir):
    """Versions and deletes of orders, arriving out of order: what is left is
    the latest version of every order that no later delete has removed."""
    return cdc.live_rows(spark, _apply_order_events(spark, sf_dir, "cdc_deletes")).select(*CLEANED_COLS)


def kpi_incremental(spark, sf_dir):
    """KPI-1 with the vehicle's KPI-2 and KPI-3 from a state that is brought up
    to date after each of the change sets of ``cdc_deletes``."""
    state = work_dir(spark, "kpi_state") + "/daily"
    _apply_order_events(spark, sf_dir, "kpi_incremental", lambda zone: _refreshed(kpi_state.refresh, spark, zone, state))
    kept = spark.read.parquet(state)
    rates = kpi_state.cancellation_rate(kept).select(
        F.col("vehicle_type").alias("_v"), "customer_cancel_rate", "driver_cancel_rate")
    means = kpi_state.averages_fare_per_km(kept).withColumnRenamed("vehicle_type", "_w")
    out = kpi_state.daily_rides_revenue(kept)
    out = out.join(rates, F.col("vehicle_type").eqNullSafe(F.col("_v")), "left")
    return out.join(means, F.col("vehicle_type").eqNullSafe(F.col("_w")), "left").drop("_v", "_w")


def dq_incremental(spark, sf_dir):
    """Quality counts kept up to date after each of the change sets of
    ``cdc_deletes``: the last of the reports kept."""
    state = work_dir(spark, "dq_state") + "/counts"
    _apply_order_events(spark, sf_dir, "dq_incremental",
                        lambda zone: _refreshed(quality_state.refresh, spark, zone, state))
    seen = quality_state.history(spark, state)
    last = seen.agg(F.max("v")).first()[0]
    return seen.where(F.col("v") == last).select("check_name", "failed")


def incremental_dim_customer(spark, sf_dir):
    """Customer dimension grown batch by batch (yearly); keys continue from
    the stored maximum and a replayed batch adds nothing."""
    root, batches = _change_sets(spark, sf_dir, "incr_dim", ["customer_id"])
    dims = incremental.IncrementalDims(f"{root}/dims", ["dim_customer"])
    for batch in [*batches, batches[-1]]:  # the last one is replayed: no-op
        dims.update(_change_set(spark, root, batch), batch)
    return dims.dimensions(spark)["dim_customer"].df


def dim_keys_over_rebuilds(spark, sf_dir):
    """Customers and vehicles rebuilt from scratch over two overlapping spans
    of years with one key map: members of both spans keep their numbers."""
    root = work_dir(spark, "rebuilds")
    names = ["dim_customer", "dim_vehicle"]
    rows = sinks.materialise(_cleaned(spark, sf_dir).select("date_id", *S.source_columns(names)), f"{root}/rows")
    for k, span in enumerate((F.col("date_id") < 19980101, F.col("date_id") >= 19970101)):
        # a rebuild is a new run: it opens the map anew
        key_map = incremental.IncrementalDims(f"{root}/key_map", names)
        star = S.add_mapped_dims(S.Star(f"{root}/build-{k}", rows.where(span)), key_map)
    out = None
    for n in names:
        d = star.dims[n]
        part = d.df.select(F.lit(n).alias("dim"), F.col(d.sk).alias("sk"), F.col(d.nk).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def stream_fact_equals_batch(spark, sf_dir):
    """Raw CSV files arrive in a landing folder; a file-source stream builds
    the star micro-batch by micro-batch.  Returned with natural keys in place
    of surrogate keys, it must equal the batch build's content."""
    root = work_dir(spark, "stream")
    landing = f"{root}/landing"
    sinks.write_csv(_raw(spark, sf_dir), landing)  # the writer's own files are the arrivals
    n = len(_files(spark, landing))
    incremental.stream_star(spark, landing, f"{root}/star", files_per_batch=max(1, -(-n // 4)))
    return incremental.fact_with_natural_keys(spark, f"{root}/star").select(*STREAM_COLS)


def stream_by_header_name(spark, sf_dir):
    """Files with the 21 columns in reverse order and files with the 18-column
    feed (its own order, one alias, odd spacing in the headers) give the same
    streamed fact."""
    root = work_dir(spark, "stream_names")
    landing = f"{root}/landing"
    raw = _raw(spark, sf_dir)
    is_returned = F.col("Booking ID").contains("-1")
    narrow = {n: h for n, h in zip(RAW_NAMES, RAW_HEADERS) if n in SOURCE_COLS}
    titles = {"reason_for_cancelling_by_customer": "Reason for  cancelling!", "booking_id": " BOOKING_ID "}
    short = raw.select(*[F.col(f"`{narrow[n]}`").alias(titles.get(n, n)) for n in SOURCE_COLS])
    sinks.write_csv(raw.where(is_returned).select(*[f"`{h}`" for h in reversed(RAW_HEADERS)]), f"{landing}/wide")
    sinks.write_csv(short.where(~F.col("` BOOKING_ID `").contains("-1")), f"{landing}/narrow")
    n = len(_files(spark, f"{landing}/wide")) + len(_files(spark, f"{landing}/narrow"))
    incremental.stream_star(spark, f"{landing}/*", f"{root}/star", files_per_batch=max(1, -(-n // 2)))
    return incremental.fact_with_natural_keys(spark, f"{root}/star").select(*STREAM_COLS)


RESENT_FILE_ROWS = 500_000     # about as many rows a file of the deliveries below


def _deliver(raw: DataFrame, path: str, parts: list[int], pieces: int, descending: bool) -> None:
    """The rows of ``parts`` as CSV, ``pieces`` files a part at most; a file's
    rows depend on their content alone, so it can be sent again."""
    at = F.col("Booking ID")
    raw = raw.withColumn("piece", F.pmod(F.xxhash64(F.lit(1), *[f"`{c}`" for c in raw.columns]), F.lit(pieces)).cast("int"))
    some = raw.where(F.col("part").isin(parts)).repartition(len(parts) * pieces, "part", "piece") \
        .sortWithinPartitions("part", "piece", at.desc() if descending else at)
    sinks.write_csv(some, path, partition_by=["part", "piece"])


def stream_resent_files(spark, sf_dir):
    """Four parts arrive as files, then two of them again under other names
    beside a new one, in micro-batches of two parts' files: the streamed fact
    has every row once."""
    root = work_dir(spark, "stream_resent")
    landing = f"{root}/landing"
    raw = _raw(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("`Booking ID`"), F.lit(5)).cast("int"))
    # a file is written by one task: their number grows with the rows, not their size
    pieces = 1 + table(spark, sf_dir, "lineitem").count() // (5 * RESENT_FILE_ROWS)
    for name, parts in (("first", [0, 1, 2, 3]), ("second", [1, 3, 4])):
        # the second delivery has its rows in another order
        _deliver(raw, f"{landing}/{name}", parts, pieces, descending=name == "second")
        incremental.stream_star(spark, f"{landing}/*/*/*", f"{root}/star", files_per_batch=2 * pieces, skip_resent=True)
    return incremental.fact_with_natural_keys(spark, f"{root}/star").select(*STREAM_COLS)


# the streamed fact: every foreign key replaced by the column it was looked up from
STREAM_COLS = [{fk: c for _, c, fk in LOOKUPS}.get(c, c) for c in FACT_COLS]


# ---- governance and layout -------------------------------------------------------

def masked_customers(spark, sf_dir, salt: str | None = None):
    st = _dims_of(spark, sf_dir, ["dim_customer"])
    # the driver's tables hold no personal data; a real run sets its own secret
    salt = salt or spark.conf.get("starlane.pii.salt", None) or "driver-tables"
    return mask_ids(st.dims["dim_customer"].df, "customer_id", salt).select(
        "customer_sk", F.col("customer_id_hash").alias("customer_hash"),
        F.col("customer_id_masked").alias("customer_masked"))


def published_pseudonyms(spark, sf_dir):
    """The star published twice, under a first salt and under its successor;
    rides a customer from the first publication, re-keyed by the rotation map,
    beside those of the second."""
    salts = ("driver-tables-1", 1), ("driver-tables-2", 2)      # the tables hold no personal data
    root = work_dir(spark, "published")
    st = S.start(spark, sf_dir, "published_star", ["customer_id", "booking_id", "date_id"])
    S.add_fact(S.add_dims(st, ["dim_customer"]), ["booking_id", "date_id", "customer_sk"], zone=False)
    st.fact = sinks.enforce_schema(st.fact, STAR_SCHEMAS["fact_booking"], strict=False)
    tables = [S.publish_masked(st, f"{root}/v{version}", salt, version) for salt, version in salts]
    rides = [t["fact_booking"].groupBy("customer_sk").count().join(t["dim_customer"], "customer_sk")
             .select("customer_id", F.col("count").alias("rides")) for t in tables]
    mapping = rotation_map(st.dims["dim_customer"].df, "customer_id", *salts)
    first = rotate(rides[0], "customer_id", mapping).toDF("customer_id", "rides_before")
    return first.join(rides[1], "customer_id", "full")


def compacted_zone(spark, sf_dir):
    """Re-lay the cleaned zone as ``year=/month=`` partitions with a bounded
    number of files (LAY-1), then read it back."""
    out = f"{work_dir(spark, 'compact')}/cleaned_by_month"
    S.compact(_cleaned(spark, sf_dir), out, ["year", "month"])
    return spark.read.parquet(out).select(*CLEANED_COLS, "year", "month")


def compacted_small_files(spark, sf_dir):
    """A zone by booking year that six appends have left in small files,
    compacted where there are too many; its content is what was appended."""
    root = work_dir(spark, "compact_small")
    rows = sinks.materialise(_cleaned(spark, sf_dir).select(*CLEANED_COLS), f"{root}/cleaned")
    zone = f"{root}/by_year"
    for k in range(6):
        part = rows.where(F.pmod(F.xxhash64(*CLEANED_COLS), F.lit(6)) == k).withColumn("year", F.year("booking_date"))
        sinks.write_parquet(part, zone, "append", partition_by=["year"])
    S.compact_small_files(spark, zone, ["year"])
    return spark.read.parquet(zone).select(*CLEANED_COLS)


def external_tables_star(spark, sf_dir):
    """Published dimension and fact folders exposed as external Parquet
    tables, queried with SQL (a star join)."""
    dims = ["dim_vehicle", "dim_payment"]
    st = S.start(spark, sf_dir, "ext_tables", ["vehicle_type", "payment_method", "booking_value"])
    st = S.add_fact(S.publish_dims(S.add_dims(st, dims)), ["vehicle_sk", "payment_sk", "booking_value"])
    tag = st.root.rsplit("-", 1)[-1]
    for name in ["fact_booking", *dims]:
        spark.sql(f"CREATE TABLE ext_{name}_{tag} USING parquet LOCATION '{S.table_path(st, name)}'")
    out = spark.sql(f"""
        SELECT v.vehicle_type, p.payment_method, count(*) AS rides,
               CAST(sum(try_cast(f.booking_value AS DECIMAL(18,2))) AS DOUBLE) AS booking_value
        FROM ext_fact_booking_{tag} f
        LEFT JOIN ext_dim_vehicle_{tag} v ON f.vehicle_sk = v.vehicle_sk
        LEFT JOIN ext_dim_payment_{tag} p ON f.payment_sk = p.payment_sk
        GROUP BY v.vehicle_type, p.payment_method""")
    for name in ["fact_booking", *dims]:  # external: the files stay, and the frame reads them
        spark.sql(f"DROP TABLE ext_{name}_{tag}")
    return out


QUERIES: dict[str, Query] = {
    "clean_headers_project": clean_headers_project,
    "csv_roundtrip_scan": csv_roundtrip_scan,
    "csv_ragged_rows": csv_ragged_rows,
    "csv_external_autodetect": csv_external_autodetect,
    "parquet_zone_view": parquet_zone_view,
    "cleaned_filtered_distinct": cleaned_filtered_distinct,
    "land_raw_if_absent": land_raw_if_absent,
    "table_sinks": table_sinks,
    "append_exactly_once": append_exactly_once,
    "quarantine_feed": quarantine_feed,
    "star_tables": star_tables,
    "star_csv_export": star_csv_export,
    "cleaned_csv": cleaned_csv,
    "single_file_exports": single_file_exports,
    "parse_timestamp_formats": parse_timestamp_formats,
    "date_only_feed": date_only_feed,
    "parse_timestamp_date_id": parse_timestamp_date_id,
    "title_trim_status": title_trim_status,
    "map_payment": map_payment,
    "strip_quotes_ids": strip_quotes_ids,
    "safe_measures": safe_measures,
    "dim_date": dim_date,
    "dim_customer": _dim_query("dim_customer"),
    "dim_vehicle": _dim_query("dim_vehicle"),
    "dim_location": _dim_query("dim_location"),
    "dim_payment": _dim_query("dim_payment"),
    "dim_reason": _dim_query("dim_reason"),
    "dim_reason_source": dim_reason_source,
    "distinct_pairs": distinct_pairs,
    "lookup_single": lookup_single,
    "lookup_role_playing": lookup_role_playing,
    "lookup_sparse_reason": lookup_sparse_reason,
    "fact_booking": fact_booking,
    "kpi_daily_rides_revenue": _kpi(kpi.kpi_daily_rides_revenue),
    "kpi_cancellation_rate": _kpi(kpi.kpi_cancellation_rate),
    "kpi_averages_fare_per_km": _kpi(kpi.kpi_averages_fare_per_km),
    "dq_report": dq_report,
    "dq_report_broken_feed": dq_report_broken_feed,
    "daily_anomalies": daily_anomalies,
    "cdc_latest_per_key": cdc_latest_per_key,
    "cdc_upsert_zone": cdc_upsert_zone,
    "cdc_deletes": cdc_deletes,
    "kpi_incremental": kpi_incremental,
    "dq_incremental": dq_incremental,
    "incremental_dim_customer": incremental_dim_customer,
    "dim_keys_over_rebuilds": dim_keys_over_rebuilds,
    "stream_fact_equals_batch": stream_fact_equals_batch,
    "stream_by_header_name": stream_by_header_name,
    "stream_resent_files": stream_resent_files,
    "masked_customers": masked_customers,
    "published_pseudonyms": published_pseudonyms,
    "compacted_zone": compacted_zone,
    "compacted_small_files": compacted_small_files,
    "external_tables_star": external_tables_star,
}
