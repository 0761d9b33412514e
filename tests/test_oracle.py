"""Every registered query against its DuckDB oracle on the smallest tables."""

import collections

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, rows_of
from starlane.plans.oracle import ORACLE
from starlane.plans.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    assert sorted(df.columns) == sorted(d_cols)
    assert collections.Counter(s_rows) == collections.Counter(d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date_id", "pickup_location", "vehicle_type", "rides",
                          "completed_rides", "revenue"]
    assert df.count() > 0
