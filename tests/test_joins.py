"""Hot keys, co-located tables and positions: results and plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tamis.operators.joins import hot_keys, split_join
from tamis.operators.position import numbered, ranked
from tamis.operators.star import Dimension, star_total
from tamis.plans.bucketed import buckets_for, is_bucketed, write_bucketed
from tests.conftest import physical


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    changed = []

    def set_(**options):
        for key, value in options.items():
            changed.append(key.replace("_", "."))
            spark.conf.set(changed[-1], value)

    yield set_
    for key in changed:
        spark.conf.unset(key)


def _fact(spark, rows=60_000):
    """A third of the rows has key 0, a thirtieth none; each row is a combination of its own."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 0 WHEN id % 31 = 0 THEN NULL ELSE id % 20000 END")
    return spark.range(rows, numPartitions=32).select(key.alias("k"), F.col("id").alias("lot"), F.lit(1).alias("m"))


def test_hot_keys_are_found_and_others_are_not(spark):
    fact = _fact(spark)
    assert hot_keys(fact, "k") == [0]
    assert hot_keys(fact.where("k <> 0"), "k") == []
    assert hot_keys(fact.limit(0), "k") == []
    assert hot_keys(fact.select(F.lit(None).cast("long").alias("k")), "k") == []
    text = fact.select(F.when(F.col("lot") % 4 == 0, "a").when(F.col("lot") % 40 == 1, "b").otherwise(F.col("lot").cast("string")).alias("k"))
    assert sorted(hot_keys(text, "k")) == ["a", "b"]


@pytest.mark.parametrize("how", ["left", "inner", "right"])
def test_split_join_equals_the_plain_one(spark, how):
    fact, side = _fact(spark, 3000), spark.range(150).selectExpr("id % 120 AS id", "id AS v")  # keys repeat
    want = fact.join(side, F.col("k") == F.col("id"), how)
    got = split_join(fact, side, "k", "id", how)
    order = lambda frame: sorted(map(tuple, frame.collect()), key=repr)
    assert order(got) == order(want)
    assert order(split_join(fact.limit(0), side, "k", "id")) == []


def test_no_task_gets_a_hot_key(spark, conf):
    conf(
        spark_sql_shuffle_partitions="64",
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_coalescePartitions_enabled="false",
    )
    fact = _fact(spark).groupBy("k", "lot").agg(F.sum("m").alias("m"))
    side = spark.range(20_000).selectExpr("id", "id % 5 AS five")
    joined = split_join(fact, side, "k", "id")
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 60_000 and max(tasks) < 0.05 * sum(tasks)
    plain = fact.join(side, F.col("k") == F.col("id"), "left")
    tasks = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) > 0.3 * sum(tasks)  # what the split avoids
    plan = physical(joined)
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1


def test_star_total_splits_large_dimensions(spark, conf):
    conf(spark_sql_autoBroadcastJoinThreshold="-1")
    fact, side = _fact(spark, 9000), spark.range(20_000).selectExpr("id", "id % 5 AS five")
    dimension = Dimension(side, "k", "id", ["five"])
    total = star_total(fact, "m", [dimension], by=["lot"])
    assert "BroadcastHashJoin" in physical(total)
    plain = star_total(fact, "m", [dimension], by=["lot"], split_hot=False)
    assert "BroadcastHashJoin" not in physical(plain)
    assert sorted(map(tuple, total.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_bucketed_tables_are_joined_without_shuffling_the_fact(spark, conf, folder):
    conf(spark_sql_autoBroadcastJoinThreshold="-1")
    rows = spark.range(5000).selectExpr("id % 700 AS k", "id AS m")
    fact = write_bucketed(rows, "bucket_fact", "k", 8, path=f"{folder}/fact")
    side = write_bucketed(
        spark.range(700).selectExpr("id", "id % 3 AS three"), "bucket_side", "id", 8, path=f"{folder}/side"
    )
    assert is_bucketed(spark, "bucket_fact", "k") and not is_bucketed(spark, "bucket_fact", "m")
    total = star_total(fact, "m", [Dimension(side, "k", "id", ["three"])])
    plan = physical(total)
    assert "SortMergeJoin" in plan
    # the only exchange is that of the few groups, above the join
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("SortMergeJoin")
    want = {n: sum(m for m in range(5000) if m % 700 % 3 == n) for n in range(3)}
    assert {r.three: r.total for r in total.collect()} == want
    # replacing the table leaves one version, and readers see the new rows
    write_bucketed(rows.where("m < 10"), "bucket_fact", "k", 8, path=f"{folder}/fact")
    assert spark.table("bucket_fact").count() == 10
    for table in ("bucket_fact", "bucket_side"):
        spark.sql(f"DROP TABLE {table}")


def test_number_of_buckets():
    assert buckets_for(0) == 8 and buckets_for(100 << 40) == 1 << 18


def test_positions_of_a_sorted_frame(spark, conf):
    rows = spark.range(5000, numPartitions=7).selectExpr("(id * 7919) % 5000 AS v", "id % 3 AS w")
    got = numbered(rows.orderBy(F.desc("v"))).collect()
    assert {r.v: r.position for r in got} == {v: 5000 - v for v in range(5000)}
    assert numbered(rows.limit(0)).collect() == []
    assert numbered(rows.withColumn("position", F.lit("x")), "place").columns == ["v", "w", "position", "place"]


def test_ranks_with_ties_and_nulls_over_several_tasks(spark, conf):
    conf(spark_sql_shuffle_partitions="16", spark_sql_adaptive_coalescePartitions_enabled="false")
    value = F.expr("CASE WHEN id % 3 = 0 THEN 50 WHEN id % 100 = 1 THEN NULL ELSE id % 100 END")
    rows = spark.range(20_000).select(value.alias("v"), "id")
    placed = ranked(rows, F.asc("v"))
    found = placed.collect()
    assert sorted(r.position for r in found) == list(range(1, 20_001))
    values = [r.v for r in sorted(found, key=lambda r: r.position)]
    assert values == sorted(values, key=lambda v: (v is not None, v))
    # no window over all rows, and ties are dealt to several ranges
    assert "Window" not in physical(placed)
    tied = rows.where("v = 50").count()
    dealt = rows.withColumn("_tie", F.xxhash64("v", "id")).repartitionByRange("v", "_tie")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.5 * tied
