"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from inkstrata.catalog import QUERIES
from tools.compare import TABLES, compare


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    text, _, good = compare(spark, con, name, sf)
    assert good, text
