"""Every registered query against its DuckDB oracle on the smallest tables,
plus the flagship entry."""

import duckdb
import pytest

import __spark_entry__ as E
from check_queries import TABLES, canon

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "event_id", "event_type", "value", "k", "ts"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(E.oracle_sql()[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(rows, cols) == canon(orows, ocols)
