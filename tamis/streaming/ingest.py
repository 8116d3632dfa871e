"""Topic streams into the lake.

``foreachBatch`` may repeat a batch after a failure.  Each batch owns the run
``<query>-<batch id>`` and replaces it with one commit, so a repeat leaves the tables
as they were; its envelopes are sent once, or again if the crash came right after.  ``query`` must be unique per lake and checkpoint: a query that
starts over with a new checkpoint needs a new name, or its batch 0 would replace
the old batch 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tamis.contracts import Contract
from tamis.plans.jobs import land_batch, promote_topic, publish_errors
from tamis.plans.lake import SILVER, Lake
from tamis.sources.topics import Topics

#: Process what is there, batch by batch, then stop.
AVAILABLE_NOW = {"availableNow": True}


def ingest_stream(
    messages: DataFrame,
    contract: Contract,
    lake: Lake,
    checkpoint: str,
    *,
    query: str = "stream",
    value: str = "value",
    trigger: dict | None = None,
    error_topics: Topics | None = None,
) -> StreamingQuery:
    """Start landing a message stream in bronze; with ``error_topics`` also publish rejects."""

    def land(batch: DataFrame, batch_id: int) -> None:
        run = f"{query}-{batch_id}"
        land_batch(batch, contract, lake, run, value=value, error_topics=error_topics)

    return _start(messages, land, checkpoint, trigger)


def medallion_stream(
    messages: DataFrame,
    contract: Contract,
    lake: Lake,
    checkpoint: str,
    *,
    query: str = "stream",
    value: str = "value",
    mode: str = "compat",
    trigger: dict | None = None,
    error_topics: Topics | None = None,
) -> StreamingQuery:
    """Start landing a stream in bronze and promoting each landed batch to silver.

    Both stages run inside the batch.  A second stream watching the bronze files
    would count a repeated batch twice, since its files are new ones.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, f"{query}-{batch_id}"
        land_batch(batch, contract, lake, run, value=value, error_topics=error_topics)
        promote_topic(spark, contract, lake, run=run, mode=mode)
        if error_topics is not None:
            publish_errors(spark, contract, lake, SILVER, error_topics, run=run)

    return _start(messages, land, checkpoint, trigger)


def _start(messages: DataFrame, land, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        messages.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
