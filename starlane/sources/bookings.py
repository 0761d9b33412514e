"""A raw, booking-shaped feed derived from the driver's TPC-H-like tables.

The source feed of the bookings ETL is a 21-column CSV of text.  It is not
available, so this module derives one with the same header and the same kind
of mess (quoted ids, padded and mixed-case text, unpadded and impossible
dates, text and huge values in numeric fields, tabs, carriage returns and
no-break spaces, empty strings, sparse reasons) from
``lineitem`` joined to ``orders``, ``customer``, ``part``, ``supplier`` and
``nation``.  Every lineitem row becomes one booking; nothing is filtered.

The column expressions are SQL text valid in both Spark SQL and DuckDB, so the
Spark plan (built with DataFrame joins, which keeps scan pruning and pushdown)
and the DuckDB oracle read exactly the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.schema import RAW_HEADERS

_ID = "CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING)"
_DEC = "CAST(CAST({} AS DECIMAL(18,2)) AS STRING)"
_CUST_R = "l.l_returnflag = 'R' AND o.o_orderstatus = 'F'"
_DRV_R = "l.l_returnflag = 'A' AND o.o_orderstatus = 'P'"
_INC_R = "l.l_returnflag = 'N' AND o.o_orderstatus = 'O'"

# header -> SQL expression over aliases l, o, c, p, s, cn, sn
RAW_EXPRS: dict[str, str] = {
    "Date": (
        "CASE WHEN l.l_linenumber = 3 THEN CAST(year(o.o_orderdate) AS STRING) || '-' || "
        "CAST(month(o.o_orderdate) AS STRING) || '-' || CAST(day(o.o_orderdate) AS STRING) "
        "WHEN l.l_linenumber = 7 THEN CAST(year(o.o_orderdate) AS STRING) || '-02-30' "
        "ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END"),
    "Time": (
        "CASE WHEN l.l_linenumber = 5 THEN NULL "
        "WHEN l.l_linenumber = 6 THEN '25:61:00' "
        "ELSE CAST(l.l_partkey % 24 AS STRING) || ':' || CAST(l.l_suppkey % 60 AS STRING) "
        "|| ':' || CAST(l.l_orderkey % 60 AS STRING) END"),
    "Booking ID": (
        f"CASE WHEN l.l_linenumber = 1 THEN '\"' || {_ID} || '\"' "
        f"WHEN l.l_linenumber = 2 THEN '\"\"\"' || {_ID} || '\"\"\"' ELSE {_ID} END"),
    "Booking Status": (
        "CASE WHEN l.l_linenumber = 4 THEN ' no-show o''neil ' "
        "WHEN o.o_orderstatus = 'F' THEN 'completed' "
        "WHEN o.o_orderstatus = 'O' THEN '  INCOMPLETE ride ' "
        "ELSE 'cancelled by DRIVER' END"),
    "Customer ID": "CASE WHEN l.l_linenumber = 3 THEN '\"' || c.c_name || '\"' ELSE c.c_name END",
    "Vehicle Type": "CASE WHEN l.l_linenumber % 2 = 0 THEN ' ' || p.p_type || ' ' ELSE p.p_type END",
    "Pickup Location": "CASE WHEN l.l_linenumber = 2 THEN chr(9) || cn.n_name || chr(160) ELSE cn.n_name END",
    "Drop Location": "CASE WHEN l.l_linenumber = 6 THEN '' WHEN l.l_linenumber = 7 THEN chr(9) ELSE sn.n_name END",
    "Avg VTAT": (
        "CASE WHEN l.l_linenumber = 5 THEN 'null' WHEN l.l_linenumber = 6 THEN '' "
        f"ELSE {_DEC.format('l.l_discount')} END"),
    "Avg CTAT": f"CASE WHEN l.l_linenumber = 4 THEN 'NaN' ELSE {_DEC.format('l.l_tax')} END",
    "Cancelled Rides by Customer": f"CASE WHEN {_CUST_R} THEN '1' ELSE '0' END",
    "Reason for cancelling by Customer": (
        f"CASE WHEN {_CUST_R} THEN (CASE WHEN l.l_linenumber % 2 = 0 "
        "THEN ' customer: ' || o.o_orderpriority || ' ' ELSE 'customer: ' || o.o_orderpriority END) "
        "WHEN l.l_returnflag = 'R' AND o.o_orderstatus = 'O' THEN '' END"),
    "Cancelled Rides by Driver": f"CASE WHEN {_DRV_R} THEN '1' ELSE '0' END",
    "Driver Cancellation Reason": f"CASE WHEN {_DRV_R} THEN 'Driver: ' || o.o_orderpriority END",
    "Incomplete Rides": f"CASE WHEN {_INC_R} THEN '1' ELSE '0' END",
    "Incomplete Rides Reason": f"CASE WHEN {_INC_R} THEN 'Incomplete: ' || o.o_orderpriority END",
    "Booking Value": (
        "CASE WHEN l.l_linenumber = 7 AND l.l_partkey % 5 = 0 THEN '1e20' "
        "WHEN l.l_linenumber = 7 AND l.l_partkey % 5 = 1 THEN 'Infinity' "
        f"ELSE {_DEC.format('l.l_extendedprice')} END"),
    "Ride Distance": _DEC.format("l.l_quantity"),
    "Driver Ratings": "CAST(1 + p.p_size % 5 AS STRING)",
    "Customer Rating": "CAST(1 + l.l_linenumber % 5 AS STRING)",
    "Payment Method": (
        "CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Upi' || chr(9) WHEN '2-HIGH' THEN chr(160) || 'Cash' || chr(13) "
        "WHEN '3-MEDIUM' THEN 'Credit Card ' WHEN '4-NOT SPECIFIED' THEN 'Debit Card' "
        "ELSE 'Wallet' END"),
}
assert list(RAW_EXPRS) == RAW_HEADERS

_FROM_SQL = """
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
"""


def raw_bookings_sql(quote: str = '"') -> str:
    """The raw feed as one SQL query (DuckDB: ``quote='"'``; Spark: ``'`'``)."""
    cols = ",\n  ".join(f"{e} AS {quote}{h}{quote}" for h, e in RAW_EXPRS.items())
    return f"SELECT\n  {cols}{_FROM_SQL}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed as a Spark DataFrame: 21 string columns, original headers.

    Joins are left joins from ``lineitem`` so no booking is lost.  The planner
    picks each strategy from the scanned sizes (broadcast for the small
    dimension tables, sort-merge for ``lineitem`` x ``orders`` at scale).
    """
    t = lambda n: table(spark, sf_dir, n)
    l = t("lineitem").alias("l")  # splits come from spark.sql.files.maxPartitionBytes
    o = t("orders").alias("o")
    c = t("customer").alias("c")
    p = t("part").alias("p")
    s = t("supplier").alias("s")
    cn = t("nation").alias("cn")
    sn = t("nation").alias("sn")
    joined = (
        l.join(o, F.col("l.l_orderkey") == F.col("o.o_orderkey"), "left")
        .join(c, F.col("o.o_custkey") == F.col("c.c_custkey"), "left")
        .join(p, F.col("l.l_partkey") == F.col("p.p_partkey"), "left")
        .join(s, F.col("l.l_suppkey") == F.col("s.s_suppkey"), "left")
        .join(cn, F.col("c.c_nationkey") == F.col("cn.n_nationkey"), "left")
        .join(sn, F.col("s.s_nationkey") == F.col("sn.n_nationkey"), "left")
    )
    return joined.select(*[F.expr(e).alias(h) for h, e in RAW_EXPRS.items()])
