from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from tamis.contracts import UnknownTopic
from tamis.operators.mapping import apply_mapping, mapping_for
from tamis.operators.sql import run_sql, run_sql_file, sql_text
from workload.queries import YEAR_TOTAL


def test_views_are_gone_and_hidden_ones_back(spark):
    spark.range(1).createOrReplaceTempView("shown")
    got = run_sql(spark, {"shown": spark.range(3), "other": spark.range(2)}, "SELECT * FROM shown, other")
    assert got.count() == 6
    assert spark.table("shown").count() == 1
    with pytest.raises(AnalysisException):
        spark.table("other")
    spark.catalog.dropTempView("shown")


def test_insured_mapping(spark):
    rows = spark.createDataFrame(
        [
            ("1", "El", "Omar", "C1", "Street", "06", "on"),
            ("2", None, "Lee", "C2", None, "07", "off"),
            ("3", None, None, "C3", None, None, None),
        ],
        "NumImm string, Nom string, Prenom string, CIN string, Adresse string, Tel string, Status string",
    )
    mapped = apply_mapping(rows, mapping_for("DimAssure"))
    assert mapped.columns == ["NumImm", "FullName", "CIN", "Coord", "Status"]
    assert [tuple(r) for r in mapped.collect()] == [
        ("1", "ElOmar", "C1", "Street | 06", "on"),
        ("2", "Lee", "C2", "07", "off"),
        ("3", "", "C3", "", None),
    ]


@pytest.mark.parametrize("kind", ["string", "float"])
def test_fact_mapping(spark, kind):
    rows = spark.createDataFrame(
        [("1", "a", "i", "202001", "-2.5"), ("2", "a", "i", "202001", None)],
        "ID string, NumAff string, NumImm string, IDPeriode string, MontantDeclaration string",
    ).withColumn("MontantDeclaration", F.col("MontantDeclaration").cast(kind))
    mapped = apply_mapping(rows, mapping_for("FactDeclaration"))
    assert mapped.columns == rows.columns
    assert [r.MontantDeclaration for r in mapped.collect()] == [2.5, None]


def test_amount_that_is_no_number_maps_to_null(spark):
    rows = spark.createDataFrame([("n/a",)], "MontantDeclaration string")
    rule = mapping_for("FactDeclaration")["MontantDeclaration"]
    assert apply_mapping(rows, {"x": rule}).first().x is None


def test_rules_may_be_text_columns_or_functions(spark):
    rows = spark.createDataFrame([(3, 4)], "a int, b int")
    rules = {"s": "a + b", "c": F.col("a") * 2, "f": lambda df: df["b"] - df["a"]}
    assert apply_mapping(rows, rules).first().asDict() == {"s": 7, "c": 6, "f": 1}


def test_topic_without_mapping():
    with pytest.raises(UnknownTopic, match="DimAffilie"):
        mapping_for("DimAffilie")


def test_year_total(spark):
    fact = spark.createDataFrame(
        [(202101, 1.0), (202112, 2.0), (202001, 4.0), (None, 8.0), (201901, None)],
        "IDPeriode int, MontantDeclaration double",
    )
    got = run_sql_file(spark, {"FactDeclaration": fact}, YEAR_TOTAL).collect()
    assert [tuple(r) for r in got] == [
        (None, 8.0), ("2019", None), ("2020", 4.0), ("2021", 3.0),
    ]


def test_sql_statements(spark):
    views = {"t": spark.range(3)}
    assert run_sql(spark, views, "SELECT sum(id) AS s FROM t;").first().s == 3
    with pytest.raises(ParseException):
        run_sql(spark, views, "SELECT 1; SELECT 2")
    with pytest.raises(AnalysisException):
        run_sql(spark, views, "SELECT nothing FROM t")


def test_sql_file_must_exist(folder):
    with pytest.raises(ValueError, match="not found"):
        sql_text(f"{folder}/none.sql")
