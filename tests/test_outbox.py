"""Error publishing of new, repeated and replaced runs."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from tamis.contracts import Contract
from tamis.operators.envelope import from_envelope
from tamis.plans import outbox
from tamis.plans.jobs import ingest, promote_topic, publish_errors
from tamis.plans.lake import BRONZE, SILVER, Lake
from tamis.plans.outbox import Outbox
from tamis.sources import store
from tamis.sources.topics import ERROR_TOPIC, Topics, read_topic

NUM = Contract.of("Num", {"n": IntegerType(), "t": StringType()})


def _messages(spark, texts):
    return spark.createDataFrame([(None, t) for t in texts], "key string, value string")


@pytest.fixture
def places(folder):
    return Lake(f"{folder}/lake"), Topics(f"{folder}/topics", "parquet")


def _originals(spark, topics):
    return Counter(r.original for r in from_envelope(read_topic(spark, topics, ERROR_TOPIC)).collect())


def test_a_newer_version_sends_what_the_last_one_had_not(spark, places):
    lake, topics = places
    versions = [["a", "a", "b"], ["a", "a", "a", "c"], ["c", "b", "b"], ["c", "b", "b"], []]
    sent, before = Counter(), Counter()
    for texts in versions:
        ingest(_messages(spark, texts), NUM, lake, run="daily")
        for _ in range(2):  # the second time sends nothing
            publish_errors(spark, NUM, lake, BRONZE, topics)
        own = Counter(texts)
        sent += own - before
        before = own
        assert _originals(spark, topics) == sent
    assert len(store.names(spark, Outbox(lake, BRONZE, NUM)._path("_sent"))) == 1


def test_only_pending_runs_are_sent(spark, places):
    lake, topics = places
    for run, texts in (("1", ["a"]), ("2", ["b", "b"]), ("3", ["c"])):
        ingest(_messages(spark, texts), NUM, lake, run=run)
    publish_errors(spark, NUM, lake, BRONZE, topics, run="2")
    assert _originals(spark, topics) == Counter(b=2)
    ingest(_messages(spark, ["b", "d"]), NUM, lake, run="2")
    publish_errors(spark, NUM, lake, BRONZE, topics)
    assert _originals(spark, topics) == Counter(a=1, b=2, c=1, d=1)
    assert Outbox(lake, BRONZE, NUM).pending(spark) == {}


def test_vacuum_does_not_lose_what_was_sent(spark, places):
    lake, topics = places
    ingest(_messages(spark, ["a", "b"]), NUM, lake, run="1")
    publish_errors(spark, NUM, lake, BRONZE, topics)
    ingest(_messages(spark, ["b", "c"]), NUM, lake, run="1")
    lake.vacuum(spark, BRONZE, NUM, hours=0)
    publish_errors(spark, NUM, lake, BRONZE, topics)
    assert _originals(spark, topics) == Counter(a=1, b=1, c=1)


def test_promotion_in_another_mode_sends_its_own_rejects(spark, places):
    lake, topics = places
    ingest(_messages(spark, ['{"n":"1.5","t":"a"}', '{"n":"x","t":"b"}']), NUM, lake)
    for mode, errors in (("compat", 1), ("strict", 2), ("compat", 2)):
        promote_topic(spark, NUM, lake, run="full", mode=mode)
        publish_errors(spark, NUM, lake, SILVER, topics)
        assert read_topic(spark, topics, ERROR_TOPIC).count() == errors


def test_a_crash_while_sending_sends_again(spark, places):
    lake, topics = places
    ingest(_messages(spark, ["a"]), NUM, lake)

    def crash(messages):
        raise RuntimeError("broker")

    with pytest.raises(RuntimeError, match="broker"):
        Outbox(lake, BRONZE, NUM).publish(spark, crash)
    publish_errors(spark, NUM, lake, BRONZE, topics)
    assert _originals(spark, topics) == Counter(a=1)


def test_many_copies_of_one_envelope(spark, places, monkeypatch):
    monkeypatch.setattr("tamis.operators.identity.CHUNK", 10)
    lake, topics = places
    ingest(_messages(spark, ["a"] * 5), NUM, lake)
    publish_errors(spark, NUM, lake, BRONZE, topics)
    ingest(_messages(spark, ["a"] * 57 + ["b"]), NUM, lake)
    publish_errors(spark, NUM, lake, BRONZE, topics)
    assert _originals(spark, topics) == Counter(a=57, b=1)
    assert outbox._NAME.keys() == {"first", "second"}


def test_tables_of_many_attempts_are_pruned_by_a_join(spark, places, monkeypatch):
    lake, _ = places
    for run in ("1", "2", "2", "3"):
        ingest(_messages(spark, ["a", '{"n":"1","t":"a"}']), NUM, lake, run=run)
    before = sorted(map(tuple, lake.table(spark, BRONZE, NUM).collect()), key=repr)
    monkeypatch.setattr("tamis.plans.lake.FEW", 0)
    table = lake.table(spark, BRONZE, NUM)
    assert sorted(map(tuple, table.collect()), key=repr) == before and len(before) == 6
    assert "dynamicpruning" in table._jdf.queryExecution().toString()
    assert lake.table(spark, BRONZE, NUM, "2").where(F.col("outcome") == "ok").count() == 1
    assert lake.table(spark, BRONZE, NUM, "none") is None
