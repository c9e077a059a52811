"""Every registered query with an SQL oracle matches DuckDB on sf0.001 (schema + values)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001
from tidepool.plans import catalog
from tools.oracle_check import TABLES, canon

QUERIES = {k: v for k, v in entry.queries().items() if k in catalog.QUERIES}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_ml():
    assert set(QUERIES) - set(SQL) <= {"classify"}
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF0001)
    rel = con.sql(SQL[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"id", "is_duplicate", "is_near_duplicate", "reply_text"} <= set(df.columns)
