"""Every registered query against its SQL in DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from tests.conftest import SMALL

import __spark_entry__ as contract
from lakemart.plans.oracle import all_sql
from lakemart.plans.registry import all_queries
from tools.compare import rows

QUERIES = all_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    mine = rows(df.columns, df.collect())
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert mine == rows(names, cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 12


def test_sql_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
