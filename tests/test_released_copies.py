"""Copies that nobody reads again are dropped while a query runs."""

import time

import pytest
from pyspark.sql import functions as F

from starlane.plans import queries
from starlane.session import apply_engine_conf, child_names, work_dir
from starlane.sinks.files import materialise

from tests.conftest import SF_SMALL


def _shuffle_files(spark) -> int:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return blocks.getAllFiles().mkString("\n").count(".data")


def test_shuffle_files_go_with_their_job(spark):
    apply_engine_conf(spark)
    before = _shuffle_files(spark)
    df = spark.range(20000).withColumn("k", F.xxhash64("id")).repartition(5, "k")
    for _ in range(3):
        materialise(df, work_dir(spark, "released"))
    for _ in range(50):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert _shuffle_files(spark) <= before


def _run(spark, monkeypatch, name: str) -> str:
    """The query's main work folder, once it has run."""
    made = []
    plain = queries.work_dir

    def kept(spark, tag):
        made.append(plain(spark, tag))
        return made[-1]
    monkeypatch.setattr(queries, "work_dir", kept)
    queries.QUERIES[name](spark, SF_SMALL).collect()
    return next(p for p in made if child_names(spark, p) and not p.rsplit("/", 1)[-1].startswith(("kpi_state", "dq_state")))


@pytest.mark.parametrize("name", ["dq_incremental", "kpi_incremental"])
def test_merged_change_sets_and_seen_differences_go(spark, monkeypatch, name):
    root = _run(spark, monkeypatch, name)
    assert "feed" not in child_names(spark, root)
    assert not [n for n in child_names(spark, f"{root}/changes") if n.startswith("batch=")]
    assert child_names(spark, f"{root}/orders__log") == ["v=3"]
    assert child_names(spark, f"{root}/orders")


def test_stream_drops_cleaned_rows_of_finished_batches(spark, monkeypatch):
    root = _run(spark, monkeypatch, "stream_resent_files")
    assert child_names(spark, f"{root}/star/fact/fact_booking")
    assert not [n for n in child_names(spark, f"{root}/star/cleaned") if n.startswith("batch_id=")]
