"""Paths that only matter at scale, exercised on small data for correctness:
hot keys, NULL-heavy lookup columns, the shuffle fallback, layout writes and
the shared-folder rule."""

import os

import pytest
from pyspark.sql import functions as F

from starlane.operators.cdc import latest_per_key
from starlane.operators.lookup import as_dimension, lookup
from starlane.plans.star import compact
from starlane.session import checkpoint_root, work_dir


@pytest.fixture(scope="module")
def skewed(spark):
    # one key holds a third of all rows, another third has no key at all
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .when(F.col("id") % 3 == 1, F.lit(None))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("v"))


def test_lookup_shuffle_path_with_hot_and_null_keys(spark, skewed):
    dim = as_dimension(spark.createDataFrame(
        [(1, "hot")] + [(i + 2, f"k{i}") for i in range(50)], "sk bigint, nk string"), "nk", "sk")
    fast = lookup(skewed, dim, "v", "v_sk")
    slow = lookup(skewed, dim, "v", "v_sk", max_bytes=0)
    plan = slow._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert slow.count() == 3000
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
    counts = {r.v_sk: r["count"] for r in slow.groupBy("v_sk").count().collect()}
    assert counts[1] == 1000 and counts[None] == 1000


def test_null_salt_spreads_null_keys_over_reducers(spark, skewed):
    dim = as_dimension(spark.createDataFrame([(1, "hot")], "sk bigint, nk string"), "nk", "sk")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup(skewed.where(F.col("v").isNull()), dim, "v", "v_sk", max_bytes=0)
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1  # NULL keys did not all land on one reducer


def test_latest_per_key_with_a_hot_key(spark, skewed):
    df = skewed.withColumn("ts", F.col("id"))
    got = {r.v: r.id for r in latest_per_key(df.where(F.col("v").isNotNull()), "v", ["ts"])
           .collect()}
    assert got["hot"] == 2997 and len(got) == 51


def test_compaction_layout(spark, tmp_root):
    df = spark.range(400).select(
        F.concat(F.lit("b"), F.col("id").cast("string")).alias("booking_id"),
        F.when(F.col("id") < 300, F.lit("2024-01-05")).otherwise(F.lit("2024-02-07"))
        .cast("date").alias("booking_date"))
    out = os.path.join(tmp_root, "compact")
    compact(df, out, files=4)
    back = spark.read.parquet(out)
    assert back.count() == 400
    assert sorted((r.year, r.month, r["count"]) for r in back.groupBy("year", "month").count()
                  .collect()) == [(2024, 1, 300), (2024, 2, 100)]
    files = [f for _, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    assert len(files) <= 4 + 2  # about `files`, never one file per task per month


def test_shared_folder_comes_from_the_session(spark):
    root = checkpoint_root(spark)
    assert root
    p = work_dir(spark, "t")
    assert p.startswith(root.rstrip("/")) and not os.path.exists(p.replace("file:", ""))  # writers make it


def test_a_fact_of_the_key_alone_is_spread_too(spark, skewed):
    """Equal rows (a projection to the key) must not share one salt."""
    from starlane.operators.dimensions import build_dim

    dim = build_dim(skewed, "d", ["v"], "nk", "sk")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for which in (F.col("v") == "hot", F.col("v").isNull()):
            out = lookup(skewed.select("v").where(which), dim, "v", "v_sk", max_bytes=0)
            sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert len(sizes) == 4 and max(r["count"] for r in sizes) < 500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_decode_spreads_hot_and_null_keys(spark, skewed):
    from starlane.operators.dimensions import build_dim
    from starlane.operators.kpi import decode

    dim = build_dim(skewed, "d", ["v"], "nk", "sk")
    keyed = lookup(skewed, dim, "v", "v_sk").drop("v")
    spark.conf.set("starlane.lookup.broadcastMaxBytes", "0")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = decode(keyed, dim, "v_sk", "v")
        for which in (F.col("v") == "hot", F.col("v").isNull()):
            sizes = out.where(which).groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 1000
        rows = sorted(map(tuple, out.select("id", "v").collect()))
    finally:
        spark.conf.unset("starlane.lookup.broadcastMaxBytes")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rows == sorted(map(tuple, skewed.collect()))


def test_the_broadcast_limit_is_in_bytes(spark):
    from starlane.operators.lookup import fits_broadcast

    few_but_long = as_dimension(spark.createDataFrame([(1, "x" * 5000), (2, "y" * 5000)], "sk bigint, nk string"),
                                "nk", "sk")
    assert few_but_long.key_bytes == 10_000
    assert fits_broadcast(spark, few_but_long, 20_000) and not fits_broadcast(spark, few_but_long, 9_000)


def test_distinct_top_k_exact_with_and_without_crowded_head(spark):
    from starlane.operators.sorts import distinct_top_k

    few_dups = spark.range(1000).select((F.col("id") % 700).alias("a"), F.lit("x").alias("b"))
    crowded = spark.range(1000).select(
        F.when(F.col("id") < 900, F.lit(0)).otherwise(F.col("id")).alias("a"),
        F.lit(None).cast("string").alias("b"))
    for df in (few_dups, crowded):
        want = df.distinct().orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first()) \
            .limit(10).collect()
        assert distinct_top_k(df, 10).collect() == want


def test_hot_member_is_salted_over_reducers(spark, skewed):
    from starlane.operators.dimensions import build_dim

    dim = build_dim(skewed, "d", ["v"], "nk", "sk")
    assert dim.freq is not None
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup(skewed, dim, "v", "v_sk", max_bytes=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        hot_sk = dim.df.where(F.col("nk") == "hot").first().sk
        spread = out.where(F.col("v") == "hot").groupBy(F.spark_partition_id()).count().collect()
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan
    assert len(spread) > 1                       # the hot member is not on one reducer
    assert len(rows) == 3000
    assert sum(1 for r in rows if r.v_sk == hot_sk) == 1000
    want = {r.id: r.v_sk for r in lookup(skewed, dim, "v", "v_sk").collect()}
    assert {r.id: r.v_sk for r in rows} == want


def test_release_work_dirs(spark):
    from starlane.session import release_work_dirs

    release_work_dirs(spark)
    p = work_dir(spark, "tmp")
    spark.range(3).write.parquet(p)
    assert os.path.isdir(p.replace("file:", ""))
    assert release_work_dirs(spark) == 1
    assert not os.path.exists(p.replace("file:", ""))
