"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from almoner.plans.registry import oracle_sql, queries
from scripts.check import TABLES, table

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())


def test_entry_runs(spark):
    import __spark_entry__

    summary = __spark_entry__.entry(spark)
    assert "segment" in summary.columns
    assert summary.count() > 0


def test_every_query_is_named_and_callable():
    assert len(queries()) > 180
    assert set(SQL) <= set(queries())
