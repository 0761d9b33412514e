"""Invariants of the star build on the driver's smallest tables."""

import pytest
from pyspark.sql import functions as F

from starlane.operators.fact import LOOKUPS, apply_lookups
from starlane.plans import star as S
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def star(spark):
    return S.add_fact(S.add_dims(S.start(spark, SF_SMALL, "invariants")))


def test_fact_keeps_every_row(star):
    assert star.fact.count() == star.cleaned.count() > 0


def test_foreign_key_null_exactly_when_source_null(star):
    joined = apply_lookups(star.cleaned, star.dims)
    for _, col, fk in LOOKUPS:
        bad = joined.where(F.col(col).isNull() != F.col(fk).isNull()).count()
        assert bad == 0, (col, fk)


def test_keys_dense_unique_and_ordered(star):
    for name, d in star.dims.items():
        rows = d.df.orderBy(d.sk).collect()
        assert [r[d.sk] for r in rows] == list(range(1, len(rows) + 1)), name
        nks = [r[d.nk] for r in rows]
        assert nks == sorted(nks) and len(set(nks)) == len(nks), name
        assert d.rows == len(rows), name


def test_rerun_gives_equal_content(spark, star):
    again = S.add_fact(S.add_dims(S.start(spark, SF_SMALL, "invariants2")))
    for name, d in star.dims.items():
        assert sorted(map(tuple, d.df.collect())) == sorted(map(tuple, again.dims[name].df.collect()))
    key = lambda r: repr(tuple(r))
    assert sorted(star.fact.collect(), key=key) == sorted(again.fact.collect(), key=key)


def test_orphan_checks_agree_on_both_paths(spark, star):
    from starlane.operators.quality import orphan_row

    small = orphan_row(star.fact, star.dims).first().asDict()
    spark.conf.set("starlane.lookup.broadcastMaxBytes", "0")
    try:
        large = orphan_row(star.fact, star.dims).first().asDict()
    finally:
        spark.conf.unset("starlane.lookup.broadcastMaxBytes")
    assert large == small
    assert all(v == 0 for k, v in small.items() if k.startswith("orphan_"))


@pytest.mark.parametrize("broadcast_bytes", [None, "0"])
def test_repeated_members_multiply_no_fact_row(spark, star, broadcast_bytes):
    from dataclasses import replace

    from starlane.operators.quality import orphan_row

    expected = orphan_row(star.fact, star.dims).first().asDict()
    twice = {n: replace(d, df=d.df.unionByName(d.df), unique=False) for n, d in star.dims.items()}
    if broadcast_bytes:
        spark.conf.set("starlane.lookup.broadcastMaxBytes", broadcast_bytes)
    try:
        assert orphan_row(star.fact, twice).first().asDict() == expected
    finally:
        spark.conf.unset("starlane.lookup.broadcastMaxBytes")


def test_broken_feed_is_checked_over_the_whole_fact(spark, star, monkeypatch):
    """The registered query hands over every fact row and dimension, and the
    report behind it has every check."""
    from starlane.operators import quality
    from starlane.plans import queries

    seen, report = {}, quality.dq_report

    def spy(cleaned, fact, dims, raw, raw_checks=None):
        seen.update(rows=fact.count(), dims=set(dims))
        seen["report"] = report(cleaned, fact, dims, raw, raw_checks)
        return seen["report"]

    monkeypatch.setattr(quality, "dq_report", spy)
    assert queries.dq_report_broken_feed(spark, SF_SMALL).count() == 31     # all checks but those of the missing columns
    assert seen["rows"] == star.fact.count() and seen["dims"] == set(star.dims)
    failed = {r.check_name: r.failed for r in seen["report"].collect()}
    assert failed["fact_row_count_diff"] == 0 and failed["missing_columns"] == 2
    assert all(failed[f"orphan_{fk}"] == 0 for fk, _ in quality.FACT_FKS)
