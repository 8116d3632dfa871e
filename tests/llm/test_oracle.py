"""The registered operators against their DuckDB counterparts, over whole tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from tamis.llm.oracle import ORACLE
from tamis.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda x: float(f"{x:.9g}") if isinstance(x, float) else x
    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", ORACLE)
def test_same_rows_as_duckdb(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    result = duck.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(columns)
    got = _rows(frame.columns, frame.collect())
    assert got == _rows(columns, result.fetchall())
    assert got
