"""Registered queries of the subpackage against their SQL on the smallest tables."""

import duckdb
import pytest

from inkstrata.llm import queries
from tools.compare import TABLES, rows_of


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def test_every_operator_is_registered():
    from __spark_entry__ import oracle_sql
    from __spark_entry__ import queries as registered

    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(registered()) and set(queries.ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, con, sf, name):
    df = queries.QUERIES[name](spark, sf)
    result = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


def test_personal_data_stays_out_of_python(spark, sf):
    plan = queries.QUERIES["op10_pii"](spark, sf)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
