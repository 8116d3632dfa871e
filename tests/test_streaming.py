from __future__ import annotations

import pytest
from pyspark.sql.types import IntegerType, StringType

from tamis.contracts import CONTRACTS, Contract
from tamis.plans.jobs import ingest, promote_topic
from tamis.plans.lake import BRONZE, SILVER, Lake
from tamis.sources.topics import ERROR_TOPIC, Topics, read_topic, stream_topic, write_topic
from tamis.streaming import (
    error_totals,
    ingest_stream,
    medallion_stream,
    stream_error_records,
    stream_error_summary,
)
from workload.messages import DECLARATIONS

NUM = Contract.of("Num", {"n": IntegerType(), "t": StringType()})


def _messages(spark, start, stop):
    shapes = ['{"n":"%d","t":"a"}', '{"n":"x%d","t":"b"}', '{"n":"%d","t":"","z":1}', '{"n":"%d"}']
    rows = [(None, shapes[i % 4] % i) for i in range(start, stop)]
    return spark.createDataFrame(rows, "key string, value string")


def _sorted(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture
def topics(spark, folder):
    topics = Topics(f"{folder}/topics", "parquet", {"maxFilesPerTrigger": "1"})
    for start in (0, 20, 40):
        write_topic(_messages(spark, start, start + 20).coalesce(1), topics, "Num")
    return topics


def test_stream_equals_batch(spark, folder, topics):
    batch, stream = Lake(f"{folder}/batch"), Lake(f"{folder}/stream")
    ingest(read_topic(spark, topics, "Num"), NUM, batch)
    promote_topic(spark, NUM, batch)
    source = stream_topic(spark, topics, "Num")
    medallion_stream(source, NUM, stream, f"{folder}/check").awaitTermination()
    for stage in (BRONZE, SILVER):
        assert _sorted(stream.rows(spark, stage, NUM)) == _sorted(batch.rows(spark, stage, NUM))
        assert stream.errors(spark, stage, NUM).count() == batch.errors(spark, stage, NUM).count()
    assert stream.rows(spark, BRONZE, NUM).count() == 45
    runs = stream.table(spark, BRONZE, NUM).select("run").distinct().count()
    assert runs == 3  # one micro-batch per file


def test_second_run_takes_only_new_messages(spark, folder, topics):
    lake = Lake(f"{folder}/lake")

    def run():
        source = stream_topic(spark, topics, "Num")
        ingest_stream(source, NUM, lake, f"{folder}/check").awaitTermination()
        return lake.rows(spark, BRONZE, NUM).count()

    assert run() == 45
    assert run() == 45
    write_topic(_messages(spark, 60, 64), topics, "Num")
    assert run() == 48


def test_repeated_batches_replace_themselves(spark, folder, topics):
    lake = Lake(f"{folder}/lake")
    for checkpoint in ("lost", "again"):  # as after a crash that lost the commits
        source = stream_topic(spark, topics, "Num")
        medallion_stream(source, NUM, lake, f"{folder}/{checkpoint}").awaitTermination()
        assert lake.rows(spark, BRONZE, NUM).count() == 45
        assert lake.rows(spark, SILVER, NUM).count() == 30


def test_queries_with_different_names_add_up(spark, folder, topics):
    lake = Lake(f"{folder}/lake")
    for name in ("one", "two"):
        source = stream_topic(spark, topics, "Num")
        ingest_stream(source, NUM, lake, f"{folder}/{name}", query=name).awaitTermination()
    assert lake.rows(spark, BRONZE, NUM).count() == 90


def test_error_log_tail(spark, folder, topics):
    lake, errors = Lake(f"{folder}/lake"), Topics(f"{folder}/errors", "parquet")
    medallion_stream(
        stream_topic(spark, topics, "Num"), NUM, lake, f"{folder}/check", error_topics=errors
    ).awaitTermination()

    def log():
        return stream_topic(spark, errors, ERROR_TOPIC)

    target = f"{folder}/summary"
    stream_error_summary(log(), target, f"{folder}/check-summary").awaitTermination()
    summary = {r.error_type: r.records for r in error_totals(spark, target).collect()}
    assert summary == {"missing_columns": 15, "extra_columns": 15, "type_cast_error": 15}
    stream_error_records(
        log(), f"{folder}/check-records", sink="parquet", path=f"{folder}/records"
    ).awaitTermination()
    records = spark.read.parquet(f"{folder}/records")
    assert records.columns == ["original", "expectedSchema", "error_type"]
    assert records.count() == 45
    # New records are added to the totals when the tail is run again.
    bad = spark.createDataFrame([(None, '{"error_type":"missing_columns"}')], "key string, value string")
    write_topic(bad, errors, ERROR_TOPIC)
    stream_error_summary(log(), target, f"{folder}/check-summary").awaitTermination()
    summary = {r.error_type: r.records for r in error_totals(spark, target).collect()}
    assert summary["missing_columns"] == 16


def test_table_in_a_folder_of_files(spark, folder):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    orders.repartition(3).write.parquet(f"{folder}/orders.parquet")
    lake, contract = Lake(f"{folder}/lake"), CONTRACTS["FactDeclaration"]
    source = DECLARATIONS.stream(spark, folder)
    ingest_stream(source, contract, lake, f"{folder}/check").awaitTermination()
    assert lake.table(spark, BRONZE, contract).count() == orders.count()
