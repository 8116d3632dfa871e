"""Every registered query against its DuckDB counterpart."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as registered
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "orders", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= registered.queries().keys()
    assert ORACLE.items() <= registered.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_duckdb(spark, duck, name):
    frame = registered.queries()[name](spark, SF_DIR)
    result = duck.execute(registered.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    got = _rows(frame.columns, frame.collect())
    assert got == _rows(columns, result.fetchall())
    assert got


def test_entry(spark):
    assert registered.entry(spark).columns == ["Year", "TotalDeclaration"]
