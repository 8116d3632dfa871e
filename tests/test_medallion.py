from __future__ import annotations

from pyspark.sql.types import IntegerType, StringType

from tamis.contracts import Contract
from tamis.operators.promote import cast_errors
from tamis.operators.validate import conforming_rows, message_errors
from tamis.plans.medallion import medallion_errors, medallion_total
from tests.conftest import optimized

NUM = Contract.of("Num", {"n": IntegerType(), "t": StringType()})
MESSAGES = [
    '{"n":"1","t":"a"}',
    '{"n":"-2","t":"a","z":0}',
    '{"n":"x","t":"b"}',
    '{"n":"x","t":"b","z":0}',
    '{"n":"4"}',
    "bad",
]


def test_errors_of_both_stages_from_one_parse(spark):
    topic = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    errors = medallion_errors(topic, NUM)
    apart = message_errors(topic, NUM).union(cast_errors(conforming_rows(topic, NUM), NUM))
    assert sorted(r.value for r in errors.collect()) == sorted(r.value for r in apart.collect())
    assert errors.count() == 6
    assert optimized(errors).count("from_json") == 1


def test_total(spark):
    topic = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    total = medallion_total(
        spark, topic, NUM, {"t": "t", "n": "abs(n)"}, "SELECT t, sum(n) AS n FROM Num GROUP BY t"
    )
    assert [tuple(r) for r in total.collect()] == [("a", 3)]
    assert optimized(total).count("from_json") == 1
