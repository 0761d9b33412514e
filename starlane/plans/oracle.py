"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code: plain SQL over the driver's tables,
using ``row_number() OVER (ORDER BY ...)`` for keys, ``UNION`` for the
role-playing dimensions and window ranking for last-write-wins.  Only the raw
feed (the shared input fixture) comes from ``raw_bookings_sql``.
"""

from __future__ import annotations

from starlane.sources.bookings import raw_bookings_sql

TITLE = ("array_to_string(list_transform(regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)', 1), "
         "lambda t: upper(left(t, 1)) || substr(t, 2)), '')")


# All Unicode white space, as SQL text of single characters.
_WHITE = " || ".join(f"chr({n})" for n in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
                                           8232, 8233, 8239, 8287, 12288])


def _strip(x: str) -> str:
    return f"trim({x}, {_WHITE})"


def _txt(x: str) -> str:
    return f"nullif({_strip(x)}, '')"


def _id(x: str) -> str:
    return _txt(f"regexp_replace({_strip(x)}, '^\"+|\"+$', '', 'g')")


def _dbl(x: str) -> str:
    number = f"TRY_CAST({_strip(x)} AS DOUBLE)"
    return f"CASE WHEN isfinite({number}) THEN {number} END"


_PAY = ("CASE {x} WHEN 'Upi' THEN 'UPI' WHEN 'Debit Card' THEN 'Debit Card' "
        "WHEN 'Credit Card' THEN 'Credit Card' WHEN 'Cash' THEN 'Cash' ELSE {x} END")

CLEAN_SELECT = f"""
  {_txt('"Date"')} AS date,
  {_txt('"Time"')} AS time,
  {_id('"Booking ID"')} AS booking_id,
  {_txt(TITLE.format(x=_strip('"Booking Status"')))} AS booking_status,
  {_id('"Customer ID"')} AS customer_id,
  {_txt('"Vehicle Type"')} AS vehicle_type,
  {_txt('"Pickup Location"')} AS pickup_location,
  {_txt('"Drop Location"')} AS drop_location,
  {_dbl('"Avg VTAT"')} AS avg_vtat,
  {_dbl('"Avg CTAT"')} AS avg_ctat,
  {_dbl('"Booking Value"')} AS booking_value,
  {_dbl('"Ride Distance"')} AS ride_distance,
  {_dbl('"Driver Ratings"')} AS driver_ratings,
  {_dbl('"Customer Rating"')} AS customer_rating,
  {_txt(_PAY.format(x=_strip('"Payment Method"')))} AS payment_method,
  {_txt('"Reason for cancelling by Customer"')} AS reason_for_cancelling_by_customer,
  {_txt('"Driver Cancellation Reason"')} AS driver_cancellation_reason,
  {_txt('"Incomplete Rides Reason"')} AS incomplete_rides_reason,
  CAST(try_strptime(concat_ws(' ', {_strip('"Date"')}, {_strip('"Time"')}), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP)
    AS booking_timestamp
"""

CLEANED_COLS_SQL = (
    "date, time, booking_id, booking_status, customer_id, vehicle_type, pickup_location, "
    "drop_location, avg_vtat, avg_ctat, booking_value, ride_distance, driver_ratings, "
    "customer_rating, payment_method, reason_for_cancelling_by_customer, "
    "driver_cancellation_reason, incomplete_rides_reason, booking_timestamp, booking_date, date_id")

RAW_NORMALISED = """
  "Date" AS date, "Time" AS time, "Booking ID" AS booking_id, "Booking Status" AS booking_status,
  "Customer ID" AS customer_id, "Vehicle Type" AS vehicle_type,
  "Pickup Location" AS pickup_location, "Drop Location" AS drop_location,
  "Avg VTAT" AS avg_vtat, "Avg CTAT" AS avg_ctat,
  "Cancelled Rides by Customer" AS cancelled_rides_by_customer,
  "Reason for cancelling by Customer" AS reason_for_cancelling_by_customer,
  "Cancelled Rides by Driver" AS cancelled_rides_by_driver,
  "Driver Cancellation Reason" AS driver_cancellation_reason,
  "Incomplete Rides" AS incomplete_rides, "Incomplete Rides Reason" AS incomplete_rides_reason,
  "Booking Value" AS booking_value, "Ride Distance" AS ride_distance,
  "Driver Ratings" AS driver_ratings, "Customer Rating" AS customer_rating,
  "Payment Method" AS payment_method
"""
RAW_NAMES = [p.strip().split(" AS ")[1] for p in RAW_NORMALISED.replace("\n", " ").split(",")]


def _dim(nk: str, sk: str, source: str) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY {nk}) AS BIGINT) AS {sk}, {nk} "
            f"FROM (SELECT DISTINCT {nk} FROM ({source}) s WHERE {nk} IS NOT NULL) d")


REASON_TYPE = ("CASE WHEN lower(reason_text) LIKE '%incomplete%' THEN 'incomplete' "
               "WHEN lower(reason_text) LIKE '%driver%' THEN 'driver_cancellation' "
               "ELSE 'customer_cancellation' END")

CTES = f"""
raw AS ({raw_bookings_sql('"')}),
cleaned0 AS (SELECT {CLEAN_SELECT} FROM raw),
cleaned AS (
  SELECT * EXCLUDE (booking_timestamp), booking_timestamp,
         CAST(booking_timestamp AS DATE) AS booking_date,
         CAST(year(booking_timestamp) * 10000 + month(booking_timestamp) * 100
              + day(booking_timestamp) AS INTEGER) AS date_id
  FROM cleaned0),
dim_customer AS ({_dim('customer_id', 'customer_sk', 'SELECT customer_id FROM cleaned')}),
dim_vehicle AS ({_dim('vehicle_type', 'vehicle_sk', 'SELECT vehicle_type FROM cleaned')}),
dim_payment AS ({_dim('payment_method', 'payment_sk', 'SELECT payment_method FROM cleaned')}),
dim_location AS ({_dim('location_name', 'location_sk',
                       'SELECT pickup_location AS location_name FROM cleaned UNION ALL '
                       'SELECT drop_location FROM cleaned')}),
dim_reason0 AS ({_dim('reason_text', 'reason_sk',
                      'SELECT reason_for_cancelling_by_customer AS reason_text FROM cleaned '
                      'UNION ALL SELECT driver_cancellation_reason FROM cleaned '
                      'UNION ALL SELECT incomplete_rides_reason FROM cleaned')}),
dim_reason AS (SELECT reason_sk, reason_text, {REASON_TYPE} AS type FROM dim_reason0),
fact AS (
  SELECT c.booking_id, c.date_id, dc.customer_sk, dv.vehicle_sk,
         lp.location_sk AS pickup_location_sk, ld.location_sk AS drop_location_sk,
         dp.payment_sk, r1.reason_sk AS customer_cancel_reason_sk,
         r2.reason_sk AS driver_cancel_reason_sk, r3.reason_sk AS incomplete_reason_sk,
         c.booking_status, c.avg_vtat, c.avg_ctat, c.booking_value, c.ride_distance,
         c.driver_ratings, c.customer_rating
  FROM cleaned c
  LEFT JOIN dim_customer dc ON c.customer_id = dc.customer_id
  LEFT JOIN dim_vehicle dv ON c.vehicle_type = dv.vehicle_type
  LEFT JOIN dim_location lp ON c.pickup_location = lp.location_name
  LEFT JOIN dim_location ld ON c.drop_location = ld.location_name
  LEFT JOIN dim_payment dp ON c.payment_method = dp.payment_method
  LEFT JOIN dim_reason r1 ON c.reason_for_cancelling_by_customer = r1.reason_text
  LEFT JOIN dim_reason r2 ON c.driver_cancellation_reason = r2.reason_text
  LEFT JOIN dim_reason r3 ON c.incomplete_rides_reason = r3.reason_text)
"""

FACT_COLS_SQL = (
    "booking_id, date_id, customer_sk, vehicle_sk, pickup_location_sk, drop_location_sk, "
    "payment_sk, customer_cancel_reason_sk, driver_cancel_reason_sk, incomplete_reason_sk, "
    "booking_status, avg_vtat, avg_ctat, booking_value, ride_distance, driver_ratings, "
    "customer_rating")


def _q(body: str) -> str:
    return f"WITH {CTES} {body}"


_DONE = ("reason_for_cancelling_by_customer IS NULL AND driver_cancellation_reason IS NULL "
         "AND incomplete_rides_reason IS NULL")
_ORDER_ALL = ", ".join(f"{c} ASC NULLS FIRST" for c in CLEANED_COLS_SQL.split(", "))
_LATEST_ORDER = ", ".join(
    f"{c} DESC NULLS LAST" for c in ["booking_timestamp"] + [
        c for c in CLEANED_COLS_SQL.split(", ") if c not in ("booking_id", "booking_timestamp")])

_BATCH = "coalesce(year(booking_date), 99999)"

ORACLE: dict[str, str] = {
    "clean_headers_project": _q(f"SELECT {RAW_NORMALISED} FROM raw"),
    "csv_roundtrip_scan": _q("SELECT " + ", ".join(
        f"nullif({n}, '') AS {n}" for n in RAW_NAMES) + f" FROM (SELECT {RAW_NORMALISED} FROM raw)"),
    "csv_external_autodetect": _q(f"SELECT {CLEANED_COLS_SQL} FROM cleaned"),
    "parquet_zone_view": _q(
        f"SELECT * FROM (SELECT DISTINCT {CLEANED_COLS_SQL} FROM cleaned) d "
        f"ORDER BY {_ORDER_ALL} LIMIT 100"),
    "land_raw_if_absent": _q(f"SELECT {RAW_NORMALISED} FROM raw"),
    "table_sinks": _q(f"SELECT 'overwrite' AS table_mode, {FACT_COLS_SQL} FROM fact "
                      f"UNION ALL SELECT 'append' AS table_mode, {FACT_COLS_SQL} FROM fact"),
    "parse_timestamp_date_id": _q(
        "SELECT booking_id, date, time, booking_timestamp, booking_date, date_id FROM cleaned"),
    "title_trim_status": _q(
        "SELECT booking_id, booking_status, vehicle_type, pickup_location, drop_location "
        "FROM cleaned"),
    "map_payment": _q("SELECT booking_id, payment_method FROM cleaned"),
    "strip_quotes_ids": _q("SELECT booking_id, customer_id FROM cleaned"),
    "safe_measures": _q(
        "SELECT booking_id, avg_vtat, avg_ctat, booking_value, ride_distance, driver_ratings, "
        "customer_rating FROM cleaned"),
    "dim_date": _q(
        "SELECT date_id, date, CAST(year(date) AS INTEGER) AS year, "
        "CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter, "
        "dayname(date) AS day_of_week FROM (SELECT date_id, min(booking_date) AS date "
        "FROM cleaned WHERE booking_date IS NOT NULL GROUP BY date_id) d"),
    "dim_customer": _q("SELECT * FROM dim_customer"),
    "dim_vehicle": _q("SELECT * FROM dim_vehicle"),
    "dim_location": _q("SELECT * FROM dim_location"),
    "dim_payment": _q("SELECT * FROM dim_payment"),
    "dim_reason": _q("SELECT * FROM dim_reason"),
    "distinct_pairs": _q("SELECT DISTINCT customer_id, pickup_location FROM cleaned"),
    "lookup_single": _q(
        "SELECT c.booking_id, c.customer_id, d.customer_sk FROM cleaned c "
        "LEFT JOIN dim_customer d ON c.customer_id = d.customer_id"),
    "lookup_role_playing": _q(
        "SELECT c.booking_id, c.pickup_location, c.drop_location, "
        "p.location_sk AS pickup_location_sk, d.location_sk AS drop_location_sk FROM cleaned c "
        "LEFT JOIN dim_location p ON c.pickup_location = p.location_name "
        "LEFT JOIN dim_location d ON c.drop_location = d.location_name"),
    "lookup_sparse_reason": _q(
        "SELECT booking_id, customer_cancel_reason_sk, driver_cancel_reason_sk, "
        "incomplete_reason_sk FROM fact"),
    "fact_booking": _q(f"SELECT {FACT_COLS_SQL} FROM fact"),
    "kpi_daily_rides_revenue": _q(
        "SELECT date_id, pickup_location, vehicle_type, count(*) AS rides, "
        f"count(CASE WHEN {_DONE} THEN 1 END) AS completed_rides, "
        f"CAST(sum(CASE WHEN {_DONE} THEN TRY_CAST(booking_value AS DECIMAL(18,2)) END) "
        "AS DOUBLE) AS revenue FROM cleaned GROUP BY date_id, pickup_location, vehicle_type"),
    "kpi_cancellation_rate": _q(
        "SELECT vehicle_type, count(*) AS rides, "
        "count(reason_for_cancelling_by_customer) AS customer_cancellations, "
        "count(driver_cancellation_reason) AS driver_cancellations, "
        "CAST(count(reason_for_cancelling_by_customer) AS DOUBLE) / count(*) AS customer_cancel_rate, "
        "CAST(count(driver_cancellation_reason) AS DOUBLE) / count(*) AS driver_cancel_rate "
        "FROM cleaned GROUP BY vehicle_type"),
    "kpi_averages_fare_per_km": _q(
        "SELECT vehicle_type, avg(driver_ratings) AS avg_driver_rating, "
        "avg(customer_rating) AS avg_customer_rating, avg(ride_distance) AS avg_ride_distance, "
        "CAST(sum(CASE WHEN ride_distance > 0 AND booking_value IS NOT NULL "
        "THEN TRY_CAST(booking_value AS DECIMAL(18,2)) END) AS DOUBLE) / "
        "sum(CASE WHEN ride_distance > 0 AND booking_value IS NOT NULL THEN ride_distance END) "
        "AS fare_per_km FROM cleaned GROUP BY vehicle_type"),
}

_MEASURES_RAW = [("avg_vtat", '"Avg VTAT"'), ("avg_ctat", '"Avg CTAT"'),
                 ("booking_value", '"Booking Value"'), ("ride_distance", '"Ride Distance"'),
                 ("driver_ratings", '"Driver Ratings"'), ("customer_rating", '"Customer Rating"')]
_FKS = [("customer_sk", "dim_customer"), ("vehicle_sk", "dim_vehicle"),
        ("pickup_location_sk", "dim_location"), ("drop_location_sk", "dim_location"),
        ("payment_sk", "dim_payment"), ("customer_cancel_reason_sk", "dim_reason"),
        ("driver_cancel_reason_sk", "dim_reason"), ("incomplete_reason_sk", "dim_reason")]
_FK_SK = {"dim_customer": "customer_sk", "dim_vehicle": "vehicle_sk",
          "dim_location": "location_sk", "dim_payment": "payment_sk", "dim_reason": "reason_sk"}

_out_of_range = ("(driver_ratings IS NOT NULL AND NOT driver_ratings BETWEEN 1 AND 5) OR "
                 "(customer_rating IS NOT NULL AND NOT customer_rating BETWEEN 1 AND 5)")
_DIM_NK = {"dim_customer": "customer_id", "dim_vehicle": "vehicle_type", "dim_location": "location_name",
           "dim_payment": "payment_method", "dim_reason": "reason_text"}
_DQ_PARTS = [
    "SELECT 'missing_columns' AS check_name, CAST(0 AS BIGINT) AS failed",
    "SELECT 'wrong_column_types', CAST(0 AS BIGINT)",
    "SELECT 'null_booking_id', count(*) FILTER (WHERE booking_id IS NULL) FROM cleaned",
    "SELECT 'null_customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM cleaned",
    "SELECT 'null_date_id', count(*) FILTER (WHERE date_id IS NULL) FROM cleaned",
    f"SELECT 'rating_out_of_range', count(*) FILTER (WHERE {_out_of_range}) FROM cleaned",
    "SELECT 'overflow_booking_value', count(*) FILTER (WHERE booking_value IS NOT NULL "
    "AND TRY_CAST(booking_value AS DECIMAL(18,2)) IS NULL) FROM cleaned",
    "SELECT 'duplicate_booking_id', count(booking_id) - count(DISTINCT booking_id) FROM cleaned",
] + [
    f"SELECT 'duplicate_{d}_{k}', count({k}) - count(DISTINCT {k}) FROM {d}"
    for d, nk in _DIM_NK.items() for k in (nk, _FK_SK[d])
] + [
    f"SELECT 'bad_{m}', count(*) FILTER (WHERE {_txt(r)} IS NOT NULL "
    f"AND {_dbl(r)} IS NULL) FROM raw" for m, r in _MEASURES_RAW
] + [
    f"SELECT 'orphan_{fk}', count(*) FROM fact WHERE {fk} IS NOT NULL "
    f"AND {fk} NOT IN (SELECT {_FK_SK[d]} FROM {d})" for fk, d in _FKS
] + [
    "SELECT 'fact_row_count_diff', abs((SELECT count(*) FROM cleaned) - (SELECT count(*) FROM fact))",
]
def _broken(part: str) -> str | None:
    """A check of the whole report as the broken feed must show it."""
    name = part.split("'")[1]
    if name in ("bad_ride_distance", "bad_customer_rating"):
        return None     # the columns are not there
    if name == "missing_columns":
        return part.replace("CAST(0 AS BIGINT)", "CAST(2 AS BIGINT)")
    if name.startswith("duplicate_dim_vehicle"):
        return f"SELECT '{name}', count(*) FROM dim_vehicle WHERE vehicle_sk % 10 = 0"
    return part.replace(_out_of_range, "driver_ratings IS NOT NULL AND NOT driver_ratings BETWEEN 1 AND 5")


_DQ_BROKEN = " UNION ALL ".join(filter(None, map(_broken, _DQ_PARTS)))


def _mapped(dim: str, col: str) -> str:
    """Numbers by the span in which a member came first, then by its text."""
    seen = f"SELECT {col} AS value, bool_or(date_id >= 19970101) AS late, " \
           f"bool_or(date_id < 19980101) AS early FROM cleaned WHERE {col} IS NOT NULL AND date_id IS NOT NULL GROUP BY {col}"
    return (f"SELECT '{dim}' AS dim, sk, value FROM (SELECT value, late, CAST(row_number() OVER "
            f"(ORDER BY NOT early, value) AS BIGINT) AS sk FROM ({seen}) s) t WHERE late")


_ANOMALY = """
daily AS (SELECT date_id, count(*) AS rides, sum(TRY_CAST(booking_value AS DECIMAL(18,2))) AS rev
          FROM fact WHERE date_id IS NOT NULL GROUP BY date_id),
d2 AS (SELECT *, CAST(strptime(CAST(date_id AS VARCHAR), '%Y%m%d') AS DATE) - DATE '1970-01-01' AS day,
              CAST(rev * 100 AS HUGEINT) AS rc, CAST(rides AS HUGEINT) AS rr FROM daily),
w AS (SELECT *, count(*) OVER win AS n, sum(rr) OVER win AS r1, sum(rr * rr) OVER win AS r2,
             sum(rc) OVER win AS v1, sum(rc * rc) OVER win AS v2
      FROM d2 WINDOW win AS (ORDER BY day RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT date_id, rides, CAST(rev AS DOUBLE) AS revenue, n AS trailing_days,
       CAST(r1 AS DOUBLE) / n AS rides_trailing_mean,
       coalesce(n >= 2 AND (n * rr - r1) * (n * rr - r1) * (n - 1) > 9 * n * (n * r2 - r1 * r1), false)
         AS rides_anomaly,
       coalesce(n >= 2 AND (n * rc - v1) * (n * rc - v1) * (n - 1) > 9 * n * (n * v2 - v1 * v1), false)
         AS revenue_anomaly
FROM w
"""

_LATEST = _q(
    f"SELECT {CLEANED_COLS_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY booking_id "
    f"ORDER BY {_LATEST_ORDER}) AS rn FROM cleaned WHERE booking_id IS NOT NULL) t WHERE rn = 1 "
    f"UNION ALL SELECT {CLEANED_COLS_SQL} FROM cleaned WHERE booking_id IS NULL")
# the upsert's feed: some rows have lost their id; yearly change sets make no
# difference to rows without id, which all stay
_NO_ID = "CASE WHEN NOT ends_with(booking_id, '0-4') THEN booking_id END"
_UPSERT = _q(
    f"SELECT {CLEANED_COLS_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY booking_id "
    f"ORDER BY {_LATEST_ORDER}) AS rn FROM (SELECT * REPLACE ({_NO_ID} AS booking_id) FROM cleaned) c) t "
    "WHERE rn = 1 OR booking_id IS NULL")
# versions and deletes of orders: the latest event of each, unless it is a delete
_ORDER_EVENTS = f"""
feed AS (SELECT * REPLACE (split_part(booking_id, '-', 1) AS booking_id), ends_with(booking_id, '-2') AS second FROM cleaned),
events AS (SELECT * EXCLUDE (second), 0 AS gone FROM feed UNION ALL BY NAME
           SELECT booking_id, booking_timestamp + INTERVAL 12 HOUR AS booking_timestamp, 1 AS gone FROM feed WHERE second),
live AS (
  SELECT {CLEANED_COLS_SQL} FROM (
    SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY
           {_LATEST_ORDER.replace("booking_timestamp DESC NULLS LAST", "booking_timestamp DESC NULLS LAST, gone DESC", 1)}) AS rn
    FROM events) t WHERE rn = 1 AND gone = 0)
"""
_KPI_LIVE = f"""
, vehicle AS (
  SELECT vehicle_type AS v, CAST(count(reason_for_cancelling_by_customer) AS DOUBLE) / count(*) AS customer_cancel_rate,
         CAST(count(driver_cancellation_reason) AS DOUBLE) / count(*) AS driver_cancel_rate,
         avg(driver_ratings) AS avg_driver_rating, avg(customer_rating) AS avg_customer_rating,
         avg(ride_distance) AS avg_ride_distance,
         CAST(sum(CASE WHEN ride_distance > 0 THEN TRY_CAST(booking_value AS DECIMAL(18,2)) END) AS DOUBLE) /
         sum(CASE WHEN ride_distance > 0 AND booking_value IS NOT NULL THEN ride_distance END) AS fare_per_km
  FROM live GROUP BY vehicle_type
), daily AS (
  SELECT date_id, pickup_location, vehicle_type, count(*) AS rides, count(CASE WHEN {_DONE} THEN 1 END) AS completed_rides,
         CAST(sum(CASE WHEN {_DONE} THEN TRY_CAST(booking_value AS DECIMAL(18,2)) END) AS DOUBLE) AS revenue
  FROM live GROUP BY date_id, pickup_location, vehicle_type
)
SELECT daily.*, vehicle.* EXCLUDE (v) FROM daily LEFT JOIN vehicle ON vehicle_type IS NOT DISTINCT FROM v
"""
_EXPORTS = [("dim_date", "date_id", "day_of_week"), ("dim_customer", "customer_sk", "customer_id"),
            ("dim_vehicle", "vehicle_sk", "vehicle_type"), ("dim_location", "location_sk", "location_name"),
            ("dim_payment", "payment_sk", "payment_method"), ("dim_reason", "reason_sk", "reason_text"),
            ("fact", "date_id", "booking_id")]
_DIM_DATE = ORACLE["dim_date"].split(" SELECT date_id, date", 1)[1]


def _exports(extra: str) -> str:
    parts = []
    for name, k, v in _EXPORTS:
        shown = "fact_booking" if name == "fact" else name
        parts.append(f"SELECT '{shown}' AS table_name, CAST({k} AS BIGINT) AS k, CAST({v} AS VARCHAR) AS v"
                     f"{extra.format(t=name)} FROM {name}")
    body = " UNION ALL ".join(parts)
    return f"WITH {CTES}, dim_date AS (SELECT date_id, date{_DIM_DATE}) {body}"


_FORMATS = ["%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%d/%m/%Y", "%Y%m%d"]
_ORDER_TEXT = """CASE o_orderkey % 6
  WHEN 0 THEN year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
  WHEN 1 THEN year(o_orderdate) || '/' || month(o_orderdate) || '/' || day(o_orderdate)
  WHEN 2 THEN strftime(o_orderdate, '%d-%m-%Y')
  WHEN 3 THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
  WHEN 4 THEN strftime(o_orderdate, '%Y%m%d')
  ELSE strftime(o_orderdate, '%b ') || day(o_orderdate) || ' ' || year(o_orderdate) END"""
_PARSE_FORMATS = f"""
WITH t AS (SELECT o_orderkey, {_ORDER_TEXT} AS date, (o_orderkey % 25) || ':5:07' AS time FROM orders)
SELECT o_orderkey, date, time,
       CAST(try_strptime(date || ' ' || time, {[f + ' %H:%M:%S' for f in _FORMATS]}) AS TIMESTAMP) AS ts,
       CAST(try_strptime(date, {_FORMATS}) AS TIMESTAMP) AS day
FROM t
"""
_DATE_ONLY = f"""
SELECT {_id('"Booking ID"')} AS booking_id, ts AS booking_timestamp,
       CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date_id,
       {_txt("coalesce(nullif(\"Reason for cancelling by Customer\", ''), nullif(\"Driver Cancellation Reason\", ''))")}
         AS reason_for_cancelling_by_customer,
       CAST(NULL AS VARCHAR) AS driver_cancellation_reason,
       TRY_CAST(split_part({_id('"Booking ID"')}, '-', 1) AS INTEGER) AS order_number
FROM (SELECT *, CAST(try_strptime({_strip('"Date"')}, '%Y-%m-%d') AS TIMESTAMP) AS ts FROM raw) r
"""

_FAULTS = [(raw, f"{name}: not {kind.lower()}", f"{raw} IS NOT NULL AND TRY_CAST({raw} AS {sql}) IS NULL")
           for name, raw, kind, sql in [
               ("avg_vtat", '"Avg VTAT"', "double", "DOUBLE"), ("avg_ctat", '"Avg CTAT"', "double", "DOUBLE"),
               ("booking_value", '"Booking Value"', "decimal(18,2)", "DECIMAL(18,2)"),
               ("ride_distance", '"Ride Distance"', "double", "DOUBLE"),
               ("driver_ratings", '"Driver Ratings"', "int", "INTEGER"),
               ("customer_rating", '"Customer Rating"', "int", "INTEGER")]]
_REASONS = "concat_ws('; ', CASE WHEN \"Time\" IS NULL THEN 'time: missing' END, " + ", ".join(
    f"CASE WHEN {test} THEN '{text}' END" for _, text, test in _FAULTS) + ")"
_QUARANTINE = f"""
judged AS (SELECT "Booking ID" AS booking_id, "Booking Value" AS text, {_REASONS} AS reasons FROM raw)
SELECT booking_id, CASE WHEN reasons = '' THEN 'kept' ELSE 'rejected' END AS part,
       CASE WHEN reasons = '' THEN CAST(TRY_CAST(text AS DECIMAL(18,2)) AS VARCHAR) ELSE text END AS value, reasons,
       (SELECT count(*) FROM judged) AS rows, (SELECT count(*) FROM judged WHERE reasons <> '') AS rejected_rows
FROM judged
"""
_MASK = ("regexp_replace(regexp_replace(regexp_replace(customer_id, '[A-Z]', 'X', 'g'), "
         "'[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')")

ORACLE.update({
    "dim_keys_over_rebuilds": _q(
        f"{_mapped('dim_customer', 'customer_id')} UNION ALL {_mapped('dim_vehicle', 'vehicle_type')}"),
    "csv_ragged_rows": _q(
        "SELECT booking_id, customer_id, CASE WHEN k <> 0 THEN vehicle_type END AS vehicle_type, k < 2 AS ragged "
        "FROM (SELECT *, (length(customer_id) + length(booking_id)) % 3 AS k FROM cleaned) c"),
    "published_pseudonyms": _q(
        "SELECT 'v2-' || sha256('driver-tables-2|outer|' || sha256('driver-tables-2|inner|' || customer_id)) AS customer_id, "
        "count(*) AS rides_before, count(*) AS rides FROM cleaned WHERE customer_id IS NOT NULL GROUP BY customer_id"),
    "append_exactly_once": _q(f"SELECT {CLEANED_COLS_SQL} FROM cleaned"),
    "quarantine_feed": f"WITH {CTES}, {_QUARANTINE}",
    "dq_report": _q(" UNION ALL ".join(_DQ_PARTS)),
    "daily_anomalies": f"WITH {CTES}, {_ANOMALY}",
    "cdc_latest_per_key": _LATEST,
    "cdc_upsert_zone": _UPSERT,
    "cdc_deletes": f"WITH {CTES}, {_ORDER_EVENTS} SELECT {CLEANED_COLS_SQL} FROM live",
    "dq_incremental": f"WITH {CTES}, {_ORDER_EVENTS} " + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {test}) AS failed FROM live" for name, test in [
            ("rows", "true"), ("null_booking_id", "booking_id IS NULL"), ("null_customer_id", "customer_id IS NULL"),
            ("null_date_id", "date_id IS NULL"), ("rating_out_of_range", _out_of_range),
            ("overflow_booking_value", "booking_value IS NOT NULL AND TRY_CAST(booking_value AS DECIMAL(18,2)) IS NULL"),
            ("negative_measure", "booking_value < 0 OR ride_distance < 0")]),
    "kpi_incremental": f"WITH {CTES}, {_ORDER_EVENTS} {_KPI_LIVE}",
    "dq_report_broken_feed": _q(_DQ_BROKEN),
    "cleaned_filtered_distinct": _q(
        f"SELECT DISTINCT {CLEANED_COLS_SQL} FROM cleaned WHERE date_id IS NOT NULL AND booking_id IS NOT NULL "
        "AND customer_id IS NOT NULL AND coalesce(booking_value, 0) >= 0 AND coalesce(ride_distance, 0) >= 0"),
    "cleaned_csv": _q(f"SELECT {CLEANED_COLS_SQL} FROM cleaned"),
    "star_tables": " UNION ALL ".join(
        f"SELECT * FROM ({_exports(f", '{mode}' AS table_mode")}) {mode}_t" for mode in ("overwrite", "append")),
    "star_csv_export": _exports(", (SELECT count(*) FROM {t}) AS rows_written"),
    "single_file_exports": _q(" UNION ALL ".join(
        f"SELECT '{form}' AS form, {files} AS files, vehicle_sk, vehicle_type FROM dim_vehicle"
        for form, files in (("csv", 1), ("parquet", 1), ("lines", 0)))),
    "parse_timestamp_formats": _PARSE_FORMATS,
    "date_only_feed": _q(_DATE_ONLY),
    "dim_reason_source": _q(
        "SELECT reason_sk, reason_text, type, concat_ws('+', "
        "CASE WHEN reason_text IN (SELECT reason_for_cancelling_by_customer FROM cleaned) THEN 'customer' END, "
        "CASE WHEN reason_text IN (SELECT driver_cancellation_reason FROM cleaned) THEN 'driver' END, "
        "CASE WHEN reason_text IN (SELECT incomplete_rides_reason FROM cleaned) THEN 'incomplete' END) "
        "AS source_type FROM dim_reason"),
    "incremental_dim_customer": _q(
        "SELECT CAST(row_number() OVER (ORDER BY b, customer_id) AS BIGINT) AS customer_sk, "
        f"customer_id FROM (SELECT customer_id, min({_BATCH}) AS b FROM cleaned "
        "WHERE customer_id IS NOT NULL GROUP BY customer_id) t"),
    "stream_fact_equals_batch": _q(
        "SELECT booking_id, date_id, customer_id, vehicle_type, pickup_location, drop_location, "
        "payment_method, reason_for_cancelling_by_customer, driver_cancellation_reason, "
        "incomplete_rides_reason, booking_status, avg_vtat, avg_ctat, booking_value, "
        "ride_distance, driver_ratings, customer_rating FROM cleaned"),
    "masked_customers": _q(
        f"SELECT customer_sk, sha256('driver-tables' || customer_id) AS customer_hash, {_MASK} AS customer_masked "
        "FROM dim_customer"),
    "compacted_zone": _q(
        f"SELECT {CLEANED_COLS_SQL}, CAST(year(booking_date) AS INTEGER) AS year, "
        "CAST(month(booking_date) AS INTEGER) AS month FROM cleaned"),
    "compacted_small_files": _q(f"SELECT {CLEANED_COLS_SQL} FROM cleaned"),
    "external_tables_star": _q(
        "SELECT vehicle_type, payment_method, count(*) AS rides, "
        "CAST(sum(TRY_CAST(booking_value AS DECIMAL(18,2))) AS DOUBLE) AS booking_value "
        "FROM cleaned GROUP BY vehicle_type, payment_method"),
})
ORACLE["stream_resent_files"] = ORACLE["stream_by_header_name"] = ORACLE["stream_fact_equals_batch"]
