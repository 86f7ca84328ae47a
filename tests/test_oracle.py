"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import oracle_queries
from tests.conftest import SMALL_SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    """The training-data queries of the optional subpackage have tests of their own."""
    assert set(entry.queries()) - set(entry.llm_queries()) == set(oracle_queries())


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SMALL_SF)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(rel.columns)
    got = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    want = [tuple(_norm(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["business_abn", "business_name", "year", "month", "month_name",
                          "total_monthly_profit", "num_of_sales"]
