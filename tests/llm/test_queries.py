"""The registered queries of this package against their SQL twins."""

import duckdb
import pytest

from newslake.llm.queries import SQL
from tools.check_queries import TABLES, compare


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", list(SQL))
def test_query(name, spark, sf, con):
    ok, note = compare(name, spark, sf, con)
    assert ok, note
