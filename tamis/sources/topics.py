"""Topics: append-only logs of ``key, value`` messages.

``format`` is ``kafka`` (the value arrives as bytes) or a file format such as
``parquet``, where a topic is the folder of its name below ``location``.  Every
operator only needs the ``value`` column, so both are interchangeable.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

MESSAGE_SCHEMA = StructType(
    [StructField("key", StringType()), StructField("value", BinaryType())]
)

_SPLITTING = {"minPartitions", "maxRecordsPerPartition"}

# Fixed value: the topic that collects the error envelopes.
ERROR_TOPIC = "ErrorLogs"


@dataclass(frozen=True)
class Topics:
    """Where topics live: Kafka bootstrap servers, or a base folder for file topics.

    ``options`` go to readers and writers, such as ``kafka.security.protocol``;
    ``read_options`` and ``write_options`` to one of them.  For Kafka, offset ranges
    are split over all cores unless ``minPartitions`` or ``maxRecordsPerPartition``
    says otherwise, so a topic partition that holds a third of all messages is not
    a single task.
    """

    location: str
    format: str = "kafka"
    options: Mapping[str, str] = field(default_factory=dict)
    read_options: Mapping[str, str] = field(default_factory=dict)
    write_options: Mapping[str, str] = field(default_factory=dict)

    def reading(self, spark: SparkSession) -> dict[str, str]:
        options = {**self.options, **self.read_options}
        if self.format == "kafka" and not _SPLITTING & options.keys():
            options["minPartitions"] = str(2 * spark.sparkContext.defaultParallelism)
        return options

    def writing(self) -> dict[str, str]:
        return {**self.options, **self.write_options}

    def path(self, topic: str) -> str:
        return f"{self.location.rstrip('/')}/{topic}"


def read_topic(spark: SparkSession, topics: Topics, topic: str) -> DataFrame:
    """The whole topic as of now: first to last offset, or all files."""
    if topics.format != "kafka":
        reader = spark.read.format(topics.format).schema(MESSAGE_SCHEMA)
        return reader.options(**topics.reading(spark)).load(topics.path(topic))
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", topics.location)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .options(**topics.reading(spark))
        .load()
    )


def spread(messages: DataFrame) -> DataFrame:
    """Use the whole cluster where the input has fewer partitions than it has cores.

    Checking messages is CPU work and costs more than moving them.  An input with
    enough partitions, as any large one has, stays as it is, without a shuffle.
    Meant for scans: counting the partitions of a shuffled frame would run it.
    """
    cores = messages.sparkSession.sparkContext.defaultParallelism
    return messages.repartition(cores) if messages.rdd.getNumPartitions() < cores else messages


def stream_topic(spark: SparkSession, topics: Topics, topic: str) -> DataFrame:
    """The topic from its first message on, as a stream."""
    if topics.format != "kafka":
        reader = spark.readStream.format(topics.format).schema(MESSAGE_SCHEMA)
        return reader.options(**topics.reading(spark)).load(topics.path(topic))
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", topics.location)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**topics.reading(spark))
        .load()
    )


def message_time(topics: Topics) -> Column:
    """When a message of a stream was written: Kafka's timestamp, or that of its file."""
    return F.col("timestamp" if topics.format == "kafka" else "_metadata.file_modification_time")


def write_topic(messages: DataFrame, topics: Topics, topic: str) -> None:
    """Append ``key, value`` messages to a topic.  An empty frame publishes nothing."""
    if topics.format != "kafka":
        stored = messages.select(*[messages[f.name].cast(f.dataType) for f in MESSAGE_SCHEMA])
        writer = stored.write.format(topics.format).options(**topics.writing())
        writer.mode("append").save(topics.path(topic))
        return
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", topics.location)
        .option("topic", topic)
        .options(**topics.writing())
        .save()
    )
