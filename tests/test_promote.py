from __future__ import annotations

import json

import pytest
from pyspark.sql.types import FloatType, IntegerType, StringType

from tamis.contracts import Contract
from tamis.operators.envelope import from_envelope, summarise_errors, to_envelope
from tamis.operators.promote import MissingColumn, cast_errors, promote, promoted_rows
from tests.conftest import AB, physical

SALE = Contract.of("Sale", {"id": IntegerType(), "who": StringType(), "sum": FloatType()})
ROWS = [
    ("1", "a", "2.5"),
    ("x", "b", "1"),
    (None, None, None),
    ("3", "", "n/a"),
    ("", "c", "4"),
    ("7.9", "d", "5"),
]


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame(ROWS, "id string, who string, sum string")


def test_rows_and_rejects(bronze):
    rows = promoted_rows(bronze, SALE)
    assert rows.schema == SALE.silver
    assert [tuple(r) for r in rows.collect()] == [
        (1, "a", 2.5),
        (None, None, None),  # a null is no cast error
        (7, "d", 5.0),
    ]
    errors = [json.loads(r.value) for r in cast_errors(bronze, SALE).collect()]
    assert [json.loads(e["original"]) for e in errors] == [
        {"id": "x", "who": "b", "sum": "1"},
        {"id": "3", "who": "", "sum": "n/a"},
        {"id": "", "who": "c", "sum": "4"},
    ]
    assert {e["error_type"] for e in errors} == {"type_cast_error"}
    assert {tuple(e["expectedSchema"]) for e in errors} == {("id", "who", "sum")}


def test_strict_mode_rejects_decimals(bronze):
    assert promoted_rows(bronze, SALE, mode="strict").count() == 2
    assert cast_errors(bronze, SALE, mode="strict").count() == 4


def test_tagged_table_holds_both_legs(bronze):
    table = promote(bronze, SALE)
    assert table.columns == ["id", "who", "sum", "envelope", "outcome"]
    ok = table.where("outcome = 'ok'").drop("envelope", "outcome")
    assert ok.collect() == promoted_rows(bronze, SALE).collect()
    rejects = table.where("outcome <> 'ok'")
    assert [r.envelope for r in rejects.collect()] == [
        r.value for r in cast_errors(bronze, SALE).collect()
    ]
    assert rejects.where("id IS NOT NULL OR who IS NOT NULL").count() == 0
    assert ok.count() + rejects.count() == bronze.count()
    assert "Exchange" not in physical(table)


def test_untyped_contract_rejects_nothing(spark):
    rows = spark.createDataFrame([("1", None)], "A string, B string")
    assert promoted_rows(rows, AB).count() == 1
    assert cast_errors(rows, AB).count() == 0


def test_columns_outside_the_contract_stay_in_the_original(spark):
    rows = spark.createDataFrame([("x", "a", "1", "more")], "id string, who string, sum string, z string")
    error = json.loads(cast_errors(rows, SALE).first().value)
    assert json.loads(error["original"])["z"] == "more"


def test_missing_contract_column(spark):
    with pytest.raises(MissingColumn, match="sum"):
        promote(spark.createDataFrame([("1", "a")], "id string, who string"), SALE)


def test_envelope_round_trip(spark):
    rows = spark.createDataFrame([('{"q":"é"}',), ("plain",), (None,)], "original string")
    log = to_envelope(rows, rows["original"], AB, "missing_columns")
    assert log.columns == ["key", "value"]
    back = from_envelope(log)
    assert back.select("original").collect() == rows.collect()
    assert {(tuple(r.expectedSchema), r.error_type) for r in back.collect()} == {
        (("A", "B"), "missing_columns")
    }


def test_envelopes_from_bytes_and_foreign_records(spark):
    texts = ['{"error_type":"extra_columns"}', "no json", "{}"]
    log = spark.createDataFrame([(t.encode(),) for t in texts], "value binary")
    assert from_envelope(log).count() == 3  # nothing is dropped
    summary = {r.error_type: r.records for r in summarise_errors(log).collect()}
    assert summary == {"extra_columns": 1, None: 2}
