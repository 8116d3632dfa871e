"""The batch jobs, one function per job and one loop over topics."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.contracts import CONTRACTS, Contract
from tamis.operators.identity import deduplicated, identified
from tamis.operators.mapping import MAPPINGS, Rule, apply_mapping, mapping_for
from tamis.operators.messages import rows_to_messages
from tamis.operators.promote import promote
from tamis.operators.sql import run_sql, sql_text
from tamis.operators.validate import checked_table
from tamis.plans.lake import BRONZE, OUTCOMES, SILVER, Lake
from tamis.plans.outbox import Outbox
from tamis.plans.warehouse import materialise
from tamis.sources.files import (
    read_csv_infer,
    read_csv_strings,
    read_delimited_rows,
    write_csv,
)
from tamis.sources.topics import (
    ERROR_TOPIC,
    Topics,
    message_time,
    read_topic,
    spread,
    stream_topic,
    write_topic,
)

log = logging.getLogger("tamis")

#: The run id of a load of everything there is; repeating it replaces the load.
FULL = "full"


def ingest(
    messages: DataFrame, contract: Contract, lake: Lake, *, run: str = FULL, value: str = "value"
) -> dict[str, int]:
    """Check messages and land them in bronze, rows and envelopes in one pass."""
    table = checked_table(messages, contract, value=value, unfiltered=True)
    return lake.write(table, BRONZE, contract, run)


def promote_topic(
    spark: SparkSession,
    contract: Contract,
    lake: Lake,
    *,
    run: str | None = None,
    mode: str = "compat",
) -> dict[str, int] | None:
    """Bronze to silver; None where bronze is absent.

    With ``run`` that run is promoted, again if it was before.  Without, all runs are
    whose newest bronze version was not promoted yet, in one pass; the silver rows of
    other runs stay as they are, also where their bronze is gone.
    """
    bronze = lake.runs(spark, BRONZE, contract, run)
    if bronze is None:
        return None
    # only what is promoted now comes to the driver, for its commit record
    states = bronze.select("run", "version")
    silver = lake.runs(spark, SILVER, contract) if run is None else None
    if silver is not None:
        done = silver.select("run", F.col("version").alias("done"))
        states = states.join(done, "run", "left").where("done IS NULL OR done < version")
    new = {r.run: r.version for r in states.collect()}
    if not new:
        return None if run is not None else dict.fromkeys(OUTCOMES[SILVER], 0)
    rows = lake.rows(spark, BRONZE, contract, new.keys(), keep=("run",))
    table = promote(rows, contract, mode=mode, keep=("run",))
    return lake.write_runs(table, SILVER, contract, new)


def publish_errors(
    spark: SparkSession,
    contract: Contract,
    lake: Lake,
    stage: str,
    topics: Topics,
    *,
    run: str | None = None,
    error_topic: str = ERROR_TOPIC,
) -> None:
    """Send the logged envelopes of a stage to the error topic, once per version of a run.

    Of a run that was replaced since, only the envelopes are sent that its last published version
    did not hold (see ``plans.outbox``).  Only the reject partitions of the stage table are read,
    the input is not parsed again; a crash between sending and noting it sends again.
    """
    outbox = Outbox(lake, stage, contract)
    outbox.publish(spark, lambda messages: write_topic(messages, topics, error_topic), run=run)


def land_batch(
    batch: DataFrame,
    contract: Contract,
    lake: Lake,
    run: str,
    *,
    value: str = "value",
    error_topics: Topics | None = None,
) -> dict[str, int]:
    """One micro-batch into bronze as a run of its own; a repeated batch replaces it."""
    counts = ingest(spread(batch), contract, lake, run=run, value=value)
    if error_topics is not None:
        publish_errors(batch.sparkSession, contract, lake, BRONZE, error_topics, run=run)
    return counts


def ingest_increment(
    messages: DataFrame,
    contract: Contract,
    lake: Lake,
    checkpoint: str,
    *,
    query: str,
    error_topics: Topics | None = None,
) -> dict[str, int]:
    """Land what a message stream holds beyond its checkpoint; the rows per outcome."""
    total = dict.fromkeys(OUTCOMES[BRONZE], 0)

    def land(batch: DataFrame, batch_id: int) -> None:
        run = f"{query}-{batch_id}"
        counts = land_batch(batch, contract, lake, run, error_topics=error_topics)
        for outcome, n in counts.items():
            total[outcome] += n

    running = (
        messages.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return total


def compact_topics(
    spark: SparkSession,
    names: Iterable[str],
    lake: Lake,
    *,
    contracts: Mapping[str, Contract] = CONTRACTS,
    hours: float = 24,
    parallel: int = 4,
) -> dict[str, Any]:
    """Merge the small files of both stages of each topic, then delete what is obsolete."""

    def job(contract: Contract) -> dict[str, int]:
        merged = {s: lake.compact(spark, s, contract) for s in (BRONZE, SILVER)}
        for stage in (BRONZE, SILVER):
            lake.vacuum(spark, stage, contract, hours=hours)
        return merged

    return _for_each_topic(spark, names, contracts, job, parallel)


def _for_each_topic(
    spark: SparkSession,
    topics: Iterable[str],
    contracts: Mapping[str, Contract],
    job: Callable[[Contract], Any],
    parallel: int,
) -> dict[str, Any]:
    """Run a job per known topic; unknown topics are skipped with a warning.

    Jobs of different topics overlap, so one topic's last tasks do not leave the
    cluster idle.  A failing topic is recorded as its exception and does not
    stop the others.
    """
    known = []
    for topic in dict.fromkeys(topics):
        if topic in contracts:
            known.append(contracts[topic])
        else:
            log.warning("no contract for topic %s, skipped", topic)
    if not known:
        return {}

    def guarded(contract: Contract) -> Any:
        try:
            return job(contract)
        except Exception as error:  # one topic must not end the others
            log.error("topic %s failed: %s", contract.topic, error)
            return error

    start = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(known)))) as pool:
        pending = {c.topic: pool.submit(start(guarded), c) for c in known}
        return {topic: future.result() for topic, future in pending.items()}


def ingest_topics(
    spark: SparkSession,
    names: Iterable[str],
    topics: Topics,
    lake: Lake,
    *,
    contracts: Mapping[str, Contract] = CONTRACTS,
    replace: str | None = None,
    query: str = "ingest",
    error_topics: Topics | None = None,
    parallel: int = 4,
    once_within: str | None = None,
) -> dict[str, Any]:
    """Ingest what is new in each topic; with ``error_topics`` also publish its envelopes.

    Offsets are kept in the lake's checkpoint of ``query``, so rows that a topic holds
    no longer stay in bronze.  ``replace`` names a run that is replaced by all that the
    topic holds now instead.  With ``once_within``, such as ``1 day``, a message that was
    written again within that time lands once; the key of a message is its id then.
    """

    def job(contract: Contract) -> dict[str, int]:
        if replace is None:
            checkpoint = lake.checkpoint(query, contract.topic)
            messages = stream_topic(spark, topics, contract.topic)
            if once_within is not None:
                time = message_time(topics)
                messages = deduplicated(messages, time=time, within=once_within)
            return ingest_increment(
                messages, contract, lake, checkpoint, query=query, error_topics=error_topics
            )
        messages = spread(read_topic(spark, topics, contract.topic))
        if once_within is not None:
            messages = deduplicated(messages)
        counts = ingest(messages, contract, lake, run=replace)
        if error_topics is not None:
            publish_errors(spark, contract, lake, BRONZE, error_topics, run=replace)
        return counts

    return _for_each_topic(spark, names, contracts, job, parallel)


def promote_topics(
    spark: SparkSession,
    names: Iterable[str],
    lake: Lake,
    *,
    contracts: Mapping[str, Contract] = CONTRACTS,
    run: str | None = None,
    mode: str = "compat",
    error_topics: Topics | None = None,
    parallel: int = 4,
) -> dict[str, Any]:
    """Promote each topic; a topic without bronze data is skipped with a warning."""

    def job(contract: Contract) -> dict[str, int] | None:
        counts = promote_topic(spark, contract, lake, run=run, mode=mode)
        if counts is None:
            log.warning("no bronze data for topic %s, skipped", contract.topic)
        elif error_topics is not None:
            publish_errors(spark, contract, lake, SILVER, error_topics, run=run)
        return counts

    return _for_each_topic(spark, names, contracts, job, parallel)


def map_csv(
    spark: SparkSession,
    topic: str,
    source: str,
    target: str,
    *,
    mappings: Mapping[str, Mapping[str, Rule]] = MAPPINGS,
) -> None:
    """Map a CSV of strings and write it as CSV without header; the target must be new."""
    mapping = mapping_for(topic, mappings)
    write_csv(apply_mapping(read_csv_strings(spark, source), mapping), target)


def map_csv_sql(
    spark: SparkSession, topic: str, source: str, sql_file: str | Path, target: str
) -> None:
    """Run a SQL file over a CSV with inferred types and replace the target CSV."""
    text = sql_text(sql_file)
    result = run_sql(spark, {topic: read_csv_infer(spark, source)}, text)
    write_csv(result, target, header=True, mode="overwrite")


def gold_table(
    spark: SparkSession,
    topic: str,
    lake: Lake,
    sql_file: str | Path,
    table: str,
    *,
    contracts: Mapping[str, Contract] = CONTRACTS,
    mappings: Mapping[str, Mapping[str, Rule]] = MAPPINGS,
    partition_by: Iterable[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Map a topic's silver rows, run a SQL file over them and replace a warehouse table."""
    silver = lake.rows(spark, SILVER, contracts[topic])
    if silver is None:
        raise ValueError(f"no silver data for topic {topic}")
    mapped = apply_mapping(silver, mapping_for(topic, mappings))
    result = run_sql(spark, {topic: mapped}, sql_text(sql_file))
    return materialise(spark, result, table, partition_by=list(partition_by), path=path)


def publish_csv(
    spark: SparkSession, files: Mapping[str, str], topics: Topics, *, ids: bool = False
) -> dict[str, Exception | None]:
    """Send each file's rows to its topic.  A bad file is reported, the rest goes on.

    With ``ids`` a message's key is its id, the same whenever the file is sent again.
    """
    outcome: dict[str, Exception | None] = {}
    for source, topic in files.items():
        try:
            rows = read_delimited_rows(spark, source)
            messages = rows_to_messages(rows)
            write_topic(identified(messages, source) if ids else messages, topics, topic)
            outcome[source] = None
        except Exception as error:  # a bad file must not stop the others
            log.error("file %s failed: %s", source, error)
            outcome[source] = error
    return outcome
