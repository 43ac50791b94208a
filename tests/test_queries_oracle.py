"""Every registered query against its DuckDB oracle on sf0.001 (the driver's
gate runs the same comparison on sf0.01), plus the entry smoke check."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools_check import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"source", "symbol", "price", "time"}
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from tickloom.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    r = con.sql(E.oracle_sql()[name])
    ocols, orows = r.columns, r.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows) == digest(ocols, orows)
