from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tamis.operators.star import Dimension, period_dimension, period_dimension_of, star_total
from tests.conftest import physical


def test_period_dimension_of_six_years(spark):
    periods = period_dimension(spark, "2020-01-01", "2025-12-31").orderBy("idperiod").collect()
    assert len(periods) == 72
    assert tuple(periods[0]) == (202001, 2020, 1) and tuple(periods[-1]) == (202512, 2025, 12)
    assert all(r.idperiod == r.year * 100 + r.month for r in periods)


def test_period_dimension_of_a_fact(spark):
    fact = spark.createDataFrame([("2020-11-30",), ("2021-01-01",), (None,)], "d string")
    got = period_dimension_of(fact, F.col("d").cast("date")).collect()
    assert sorted(r.idperiod for r in got) == [202011, 202012, 202101]


def _brute(rows, dimension):
    totals = {}
    for key, year, amount in rows:
        slot = (year, dimension.get(key))
        totals[slot] = totals.get(slot, 0) + amount
    return totals


def test_totals_with_a_hot_key_and_unknown_members(spark):
    rows = [(0 if i % 3 else i % 17, 2020 + i % 2, i) for i in range(900)]
    places = {key: f"p{key % 4}" for key in range(12)}  # members 12 to 16 are unknown
    fact = spark.createDataFrame(rows, "k int, y int, amount int")
    dimension = spark.createDataFrame(list(places.items()), "id int, place string")
    total = star_total(fact, "amount", [Dimension(dimension, "k", "id", ["place"])], by=["y"])
    assert {(r.y, r.place): r.total for r in total.collect()} == _brute(rows, places)
    inner = star_total(
        fact, "amount", [Dimension(dimension, "k", "id", ["place"])], by=["y"], how="inner"
    )
    assert None not in {r.place for r in inner.collect()}


def test_equal_names_in_fact_and_dimensions(spark):
    fact = spark.createDataFrame([(1, 7, 10), (1, 8, 5), (2, 7, 1)], "NumImm int, NumAff int, m int")
    one = spark.createDataFrame([(1, "on", 3), (2, "off", 4)], "NumImm int, Status string, m int")
    two = spark.createDataFrame([(7, "new"), (8, "old")], "NumAff int, Status string")
    dimensions = [
        Dimension(one, "NumImm", "NumImm", ["Status", "NumImm"], "a_"),
        Dimension(two, "NumAff", "NumAff", ["Status"]),
    ]
    got = star_total(fact, "m", dimensions, total="m")
    assert got.columns == ["a_Status", "a_NumImm", "Status", "m"]
    assert sorted(map(tuple, got.collect())) == [
        ("off", 2, "new", 1),
        ("on", 1, "new", 10),
        ("on", 1, "old", 5),
    ]
    with pytest.raises(ValueError, match="Status"):
        star_total(fact, "m", [dimensions[1], Dimension(one, "NumImm", "NumImm", ["Status"])])


def test_small_dimensions_come_before_any_shuffle_of_the_fact(spark):
    fact = spark.range(1000).selectExpr("id % 3 AS k", "id AS j", "id AS amount")
    sides = [spark.range(1000).selectExpr("id", f"id % {n} AS v{n}") for n in (2, 3)]
    total = star_total(
        fact, "amount", [Dimension(sides[0], "k", "id", ["v2"]), Dimension(sides[1], "j", "id", ["v3"])]
    )
    plan = physical(total)
    assert plan.count("BroadcastHashJoin") == 2
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1  # that of the groups, above the partial sum
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_sum")
    assert sum(r.total for r in total.collect()) == sum(range(1000))


def test_hot_key_with_many_other_keys(spark):
    rows = spark.range(6000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS j", "1 AS amount")
    side = spark.range(6000).selectExpr("id", "id % 5 AS five")
    want = sorted(map(tuple, rows.selectExpr("k % 5 AS a", "j % 5 AS b").groupBy("a", "b").count().collect()))
    for bound in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            got = star_total(
                rows, "amount", [Dimension(side, "k", "id", ["five"], "k"), Dimension(side, "j", "id", ["five"], "j")]
            )
            assert sorted(map(tuple, got.collect())) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fact_is_summed_before_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.range(100).selectExpr("id % 7 AS k", "id AS amount")
        dimension = spark.range(7).selectExpr("id", "id % 2 AS odd")
        total = star_total(fact, "amount", [Dimension(dimension, "k", "id", ["odd"])])
        plan = physical(total)
        join, partial = plan.index("Join"), plan.rindex("partial_sum(m")
        assert join < partial  # further down in the tree, so before the join
        assert "Broadcast" not in plan
        assert sum(r.total for r in total.collect()) == 4950
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
