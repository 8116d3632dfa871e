"""The error log as a stream, from its first record on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tamis.operators.envelope import from_envelope, summarise_errors
from tamis.sources import store
from tamis.streaming.ingest import AVAILABLE_NOW


def stream_error_records(
    log: DataFrame, checkpoint: str, *, sink: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    """Append each decoded envelope to a sink, such as a file format with ``path``."""
    return (
        from_envelope(log)
        .writeStream.format(sink)
        .outputMode("append")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def stream_error_summary(
    log: DataFrame, target: str, checkpoint: str, *, trigger: dict | None = None
) -> StreamingQuery:
    """Keep each micro-batch's records per error_type below ``target``.

    A batch holds at most one row per error type and replaces its own folder when
    repeated, so no state is needed and no record counts twice.  ``error_totals``
    adds the batches up.  A new checkpoint needs a new target.
    """

    def count(batch: DataFrame, batch_id: int) -> None:
        summarise_errors(batch).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        log.writeStream.foreachBatch(count)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def error_totals(spark: SparkSession, target: str) -> DataFrame:
    """Records per error_type over all micro-batches of ``stream_error_summary``."""
    counts = spark.read.schema("error_type string, records long, batch long").parquet(target)
    return counts.groupBy("error_type").agg(F.sum("records").alias("records"))


def stream_error_totals(
    log: DataFrame, target: str, checkpoint: str, *, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the records per error_type of the whole log below ``target``.

    The counts are state of the stream, one row per error type in the checkpoint's state store.
    Each micro-batch writes them all to a new folder and then deletes all but the one before, for
    readers that are under way; so storage does not grow with micro-batches.  A restart goes on
    with the state, and a repeated batch writes the same totals again.
    """

    def show(totals: DataFrame, batch_id: int) -> None:
        spark = totals.sparkSession
        totals.coalesce(1).write.parquet(f"{target}/{_SNAPSHOT}{batch_id:012d}-{uuid.uuid4().hex}")
        for name in sorted(_snapshots(spark, target))[:-2]:
            store.remove(spark, f"{target}/{name}")

    return (
        summarise_errors(log)
        .writeStream.outputMode("complete")
        .foreachBatch(show)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


_SNAPSHOT = "batch-"


def _snapshots(spark: SparkSession, target: str) -> list[str]:
    """Complete snapshots; one that is being written has no mark of success yet."""
    found = [name for name in store.names(spark, target) if name.startswith(_SNAPSHOT)]
    return [name for name in found if store.exists(spark, f"{target}/{name}/_SUCCESS")]


def running_totals(spark: SparkSession, target: str) -> DataFrame:
    """Records per error_type as of the last micro-batch of ``stream_error_totals``."""
    schema = "error_type string, records long"
    found = _snapshots(spark, target)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{target}/{max(found)}")
