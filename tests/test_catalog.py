"""Every registered query against its SQL on the smallest data."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import TABLES, rows_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF_DIR)
    got = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
