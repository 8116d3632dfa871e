"""Totals by increments against a recompute."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StringType

from tamis.contracts import Contract
from tamis.plans import totals as module
from tamis.plans.jobs import ingest, promote_topic
from tamis.plans.lake import SILVER, Lake
from tamis.plans.totals import Totals, new_runs, refresh_totals
from tamis.sources import store
from tamis.sources.topics import Topics, stream_topic, write_topic
from tamis.streaming import running_totals, stream_error_totals

SALE = Contract.of("Sale", {"day": IntegerType(), "shop": StringType(), "amount": FloatType()})
TOTALS = Totals(
    {"month": "day DIV 100", "shop": "shop"},
    {"total": ("sum", "amount"), "sales": ("count", "1"), "least": ("min", "amount"), "most": ("max", "day")},
)


def _messages(spark, start, stop, bad=False):
    amount = "x" if bad else "%d"
    rows = [(None, f'{{"day":"{100 + i}","shop":"s{i % 3}","amount":"{amount}"}}'.replace("%d", str(i))) for i in range(start, stop)]
    return spark.createDataFrame(rows, "key string, value string")


def _recomputed(spark, lake):
    rows = lake.rows(spark, SILVER, SALE).selectExpr("day DIV 100 AS month", "shop", "amount", "day")
    values = F.sum("amount"), F.count(F.lit(1)), F.min("amount"), F.max("day")
    return sorted(map(tuple, rows.groupBy("month", "shop").agg(*values).collect()))


@pytest.fixture
def table(spark):
    spark.sql("DROP TABLE IF EXISTS sale_totals")
    yield "sale_totals"
    spark.sql("DROP TABLE IF EXISTS sale_totals")


def test_equals_a_recompute_after_append_replace_and_reject(spark, folder, table, monkeypatch):
    lake, scanned = Lake(f"{folder}/lake"), []
    rows = Lake.rows

    def recorded(self, spark, stage, contract, run=None, keep=()):
        if keep and stage == SILVER:
            scanned.append(sorted(run))
        return rows(self, spark, stage, contract, run, keep)

    assert refresh_totals(spark, SALE, lake, TOTALS, table, path=f"{folder}/gold") is None
    steps = [("a", 0, 50, False), ("b", 50, 200, False), ("a", 20, 90, False), ("c", 0, 30, True), ("b", 0, 10, True)]
    for run, start, stop, bad in steps:
        ingest(_messages(spark, start, stop, bad), SALE, lake, run=run)
        promote_topic(spark, SALE, lake)
        monkeypatch.setattr(Lake, "rows", recorded)
        got = refresh_totals(spark, SALE, lake, TOTALS, table, path=f"{folder}/gold")
        monkeypatch.setattr(Lake, "rows", rows)
        assert got.columns == ["month", "shop", "total", "sales", "least", "most"]
        assert sorted(map(tuple, got.collect())) == _recomputed(spark, lake)
    assert scanned == [["a"], ["b"], ["a"], ["c"], ["b"]]  # new versions only
    refresh_totals(spark, SALE, lake, TOTALS, table, path=f"{folder}/gold")
    live = lake.runs(spark, SILVER, SALE)
    assert new_runs(live, spark.table(table)).count() == 0
    assert len(store.names(spark, f"{folder}/gold")) == 2  # the current version and the one before


def test_old_runs_are_not_read(spark, folder, table):
    lake = Lake(f"{folder}/lake")
    ingest(_messages(spark, 0, 10), SALE, lake, run="old")
    promote_topic(spark, SALE, lake)
    refresh_totals(spark, SALE, lake, TOTALS, table, path=f"{folder}/gold")
    attempt = lake.live(spark, SILVER, SALE)["old"].attempt
    store.remove(spark, lake.path(SILVER, "Sale", attempt))  # reading it would show
    ingest(_messages(spark, 10, 40), SALE, lake, run="new")
    promote_topic(spark, SALE, lake)
    got = refresh_totals(spark, SALE, lake, TOTALS, table, path=f"{folder}/gold")
    assert sum(r.sales for r in got.collect()) == 40


def test_a_failing_refresh_keeps_the_totals(spark, folder, table, monkeypatch):
    lake = Lake(f"{folder}/lake")
    ingest(_messages(spark, 0, 10), SALE, lake, run="1")
    promote_topic(spark, SALE, lake)
    before = refresh_totals(spark, SALE, lake, TOTALS, table, path=f"{folder}/gold")
    want = sorted(map(tuple, before.collect()))
    ingest(_messages(spark, 10, 20), SALE, lake, run="2")
    promote_topic(spark, SALE, lake)
    broken = Totals(TOTALS.by, {**TOTALS.values, "total": ("sum", "raise_error('broken')")})
    with pytest.raises(Exception, match="broken"):
        refresh_totals(spark, SALE, lake, broken, table, path=f"{folder}/gold")
    assert sorted(map(tuple, TOTALS.merged(spark.table(table)).collect())) == want


def test_aggregates_must_merge():
    with pytest.raises(ValueError, match="avg"):
        Totals({}, {"x": ("avg", "amount")})
    assert module._MERGE.keys() == module._PART.keys()


def test_running_error_totals_keep_counts_and_storage(spark, folder):
    topics = Topics(f"{folder}/topics", "parquet", {"maxFilesPerTrigger": "1"})
    target, check = f"{folder}/totals", f"{folder}/check"
    assert running_totals(spark, target).count() == 0

    def run():
        log = stream_topic(spark, topics, "E")
        stream_error_totals(log, target, check).awaitTermination()
        return {r.error_type: r.records for r in running_totals(spark, target).collect()}

    def write(kinds):
        rows = [(None, f'{{"error_type":"{k}"}}') for k in kinds]
        write_topic(spark.createDataFrame(rows, "key string, value string").coalesce(1), topics, "E")

    for _ in range(4):
        write(["a", "a", "b"])
    assert run() == {"a": 8, "b": 4}
    for n in range(1, 4):
        write(["b", "c"])
        assert run() == {"a": 8, "b": 4 + n, "c": n}  # a restart goes on with the counts
        assert len(store.names(spark, target)) <= 2
    assert run() == {"a": 8, "b": 7, "c": 3}
