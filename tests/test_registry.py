from __future__ import annotations

import duckdb
import pytest

from check import compare
from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF
from millrace.registry import all_queries
from millrace.registry.views import TABLES


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_its_sql_twin(spark, con, name):
    verdict, n_rows = compare(spark, con, SF, name, queries()[name], oracle_sql()[name])
    assert verdict == "ok"
    assert n_rows > 0


def test_every_twin_has_a_query():
    assert set(all_queries()) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert {row.status for row in entry(spark).collect()} == {
        "completed",
        "cancelled",
        "no_driver",
    }
