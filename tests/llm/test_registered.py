"""Registered corpus queries: against their SQL, or for their rows."""

from pathlib import Path

import duckdb
import pytest
from tests.conftest import SMALL

from lakemart.llm.queries import QUERIES, SQL
from tools.compare import rows


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
    if name not in SQL:
        assert mine
        return
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert mine == rows(names, cursor.fetchall())


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
