"""Registered queries against their DuckDB oracles on the smallest table."""

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF001

QUERIES = sorted(E._QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"create view events as select * from read_parquet('{SF001}/events.parquet')")
    return c


def _norm(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF001).toPandas()
    want = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got.astype(object).where(got.notna(), None)) == _norm(want.astype(object).where(want.notna(), None))


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() >= 1
