from __future__ import annotations

import pytest
from pyspark.sql.types import FloatType, IntegerType, StringType

from tamis.contracts import CONTRACTS, Contract, UnknownTopic


def test_registry_holds_three_topics_in_field_order():
    assert list(CONTRACTS) == ["FactDeclaration", "DimAssure", "DimAffilie"]
    assert CONTRACTS["FactDeclaration"].names == [
        "ID", "NumAff", "NumImm", "IDPeriode", "MontantDeclaration",
    ]
    assert len(CONTRACTS["DimAssure"].names) == 7
    assert len(CONTRACTS["DimAffilie"].names) == 17


def test_silver_types_differ_from_bronze_in_two_fields():
    fact = CONTRACTS["FactDeclaration"]
    assert {f.dataType for f in fact.bronze} == {StringType()}
    assert fact.silver["ID"].dataType == IntegerType()
    assert fact.silver["MontantDeclaration"].dataType == FloatType()
    for topic in ("DimAssure", "DimAffilie"):
        assert CONTRACTS[topic].silver == CONTRACTS[topic].bronze


def test_unknown_topic():
    assert "Nothing" not in CONTRACTS
    with pytest.raises(UnknownTopic, match="Nothing"):
        CONTRACTS["Nothing"]


def test_extended_keeps_the_others():
    more = CONTRACTS.extended(Contract.of("T", {"x": StringType()}))
    assert list(more)[-1] == "T" and len(more) == 4 and len(CONTRACTS) == 3


@pytest.mark.parametrize(
    "fields",
    [
        {},
        {"Outcome": StringType()},
        {"a": StringType(), "A": StringType()},
        {"a.b": StringType()},
    ],
)
def test_bad_contracts_are_refused(fields):
    with pytest.raises(ValueError):
        Contract.of("T", fields)
