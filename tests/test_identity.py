"""Message ids and topics that hold messages twice."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from tamis.contracts import Contract, Contracts
from tamis.operators.identity import deduplicated, identified, repeated
from tamis.plans.jobs import ingest_topics, publish_csv
from tamis.plans.lake import BRONZE, Lake
from tamis.sources.topics import Topics, message_time, read_topic, stream_topic, write_topic

NUM = Contract.of("Num", {"n": IntegerType(), "t": StringType()})


def _values(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("chunk", [10_000, 3])
def test_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr("tamis.operators.identity.CHUNK", chunk)
    rows = spark.createDataFrame([("a", 7), ("b", 0), ("c", 1), (None, 3)], "v string, n long")
    got = Counter(map(tuple, repeated(rows, "n").collect()))
    assert got == Counter([(v, i) for v, n in (("a", 7), ("c", 1), (None, 3)) for i in range(1, n + 1)])


def test_ids_tell_equal_messages_apart_and_repeat(spark):
    values = ["x", "x", "y", "", None, None, "x"]
    first = identified(_values(spark, values), "file").collect()
    again = identified(_values(spark, values[::-1]).repartition(3), "file").collect()
    assert len({r.key for r in first}) == len(values)
    assert {(r.key, r.value) for r in first} == {(r.key, r.value) for r in again}
    other = {r.key for r in identified(_values(spark, values), "other").collect()}
    assert not other & {r.key for r in first}
    more = identified(_values(spark, [*values, "x"]), "file").collect()  # an added row has a new id
    assert len({r.key for r in more} - {r.key for r in first}) == 1
    assert identified(_values(spark, []), "file").count() == 0


def test_batch(spark):
    rows = [("1", "a"), ("1", "a"), ("2", "a"), (None, "b"), (None, "b")]
    messages = spark.createDataFrame(rows, "key string, value string")
    assert sorted(map(tuple, deduplicated(messages).collect()), key=repr) == [
        ("1", "a"), ("2", "a"), (None, "b"), (None, "b"),
    ]


def test_stream_keeps_ids_over_restarts_and_within_the_watermark(spark, folder):
    topics = Topics(f"{folder}/topics", "parquet")

    def run():
        messages = stream_topic(spark, topics, "T")
        query = (
            deduplicated(messages, time=message_time(topics), within="1 hour")
            .writeStream.format("parquet")
            .option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/check")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return Counter(bytes(r.value) for r in spark.read.parquet(f"{folder}/out").collect())

    first = [("1", "a"), ("2", "b"), ("2", "b"), (None, "c")]
    write_topic(spark.createDataFrame(first, "key string, value string"), topics, "T")
    assert run() == Counter({b"a": 1, b"b": 1, b"c": 1})
    second = [("2", "b"), ("3", "d"), (None, "c")]
    write_topic(spark.createDataFrame(second, "key string, value string"), topics, "T")
    assert run() == Counter({b"a": 1, b"b": 1, b"c": 2, b"d": 1})
    with pytest.raises(ValueError, match="time"):
        deduplicated(stream_topic(spark, topics, "T"))


def test_state_is_bounded_by_the_watermark(spark, folder):
    """Ids go from the state once the watermark has passed them."""
    schema = "key string, value string, at timestamp"

    def run(rows):
        spark.createDataFrame(rows, "key string, value string, at string").withColumn(
            "at", F.col("at").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        messages = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = (
            deduplicated(messages, time=F.col("at"), within="1 hour")
            .writeStream.format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/check").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert run([(str(i), "v", "2024-01-01 00:00:00") for i in range(50)]) == 50
    run([("late", "v", "2024-01-02 00:00:00")])
    assert run([("later", "v", "2024-01-02 00:10:00")]) <= 2
    assert spark.read.parquet(f"{folder}/out").count() == 52


def test_a_file_published_twice_lands_once(spark, folder):
    topics, contracts = Topics(f"{folder}/topics", "parquet"), Contracts(NUM)
    source = f"{folder}/num.csv"
    with open(source, "w") as file:
        file.write("n,t\n1,a\n1,a\n2,b\n")
    for _ in range(2):
        assert publish_csv(spark, {source: "Num"}, topics, ids=True)[source] is None
    assert read_topic(spark, topics, "Num").count() == 6
    for replace in (None, "all"):
        lake = Lake(f"{folder}/lake-{replace}")
        done = ingest_topics(
            spark, ["Num"], topics, lake, contracts=contracts, once_within="1 day", replace=replace
        )
        assert done["Num"]["ok"] == 3
        assert sorted(map(tuple, lake.rows(spark, BRONZE, NUM).collect())) == [("1", "a"), ("1", "a"), ("2", "b")]
