"""The Kafka calls, recorded: no broker and no connector is at hand."""

from __future__ import annotations

from unittest.mock import MagicMock

from tamis.sources.topics import Topics, read_topic, stream_topic, write_topic

KAFKA = Topics(
    "broker:9092",
    options={"kafka.security.protocol": "SSL"},
    read_options={"minPartitions": "64"},
    write_options={"includeHeaders": "true"},
)
READ = ("options", ("kafka.security.protocol", "SSL"), ("minPartitions", "64"))


class Recorder:
    """Stands for a reader or writer; every call returns the recorder itself."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, *args, *sorted(kwargs.items())))
            return self

        return call


def test_bounded_read():
    spark = MagicMock(read=Recorder())
    read_topic(spark, KAFKA, "T")
    assert spark.read.calls == [
        ("format", "kafka"),
        ("option", "kafka.bootstrap.servers", "broker:9092"),
        ("option", "subscribe", "T"),
        ("option", "startingOffsets", "earliest"),
        ("option", "endingOffsets", "latest"),
        READ,
        ("load",),
    ]


def test_stream_has_no_end():
    spark = MagicMock(readStream=Recorder())
    stream_topic(spark, KAFKA, "T")
    options = [call[1] for call in spark.readStream.calls if call[0] == "option"]
    assert options == ["kafka.bootstrap.servers", "subscribe", "startingOffsets"]
    assert READ in spark.readStream.calls


def test_write():
    writer = Recorder()
    frame = MagicMock()
    frame.select.return_value.write = writer
    write_topic(frame, KAFKA, "T")
    frame.select.assert_called_with("key", "value")
    assert writer.calls == [
        ("format", "kafka"),
        ("option", "kafka.bootstrap.servers", "broker:9092"),
        ("option", "topic", "T"),
        ("options", ("includeHeaders", "true"), ("kafka.security.protocol", "SSL")),
        ("save",),
    ]


def test_offset_ranges_are_split_by_default():
    spark = MagicMock()
    spark.sparkContext.defaultParallelism = 8
    assert Topics("broker:9092").reading(spark) == {"minPartitions": "16"}
    own = Topics("broker:9092", read_options={"maxRecordsPerPartition": "5"})
    assert own.reading(spark) == {"maxRecordsPerPartition": "5"}
    assert Topics("folder", "parquet").reading(spark) == {}
