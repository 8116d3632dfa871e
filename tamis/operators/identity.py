"""Messages that can be told apart, and topics that deliver some of them twice.

A topic that is written at least once holds a message twice when its writer, or the task that
wrote it, tried again.  Equal rows of one file are different messages, though, so the text alone
does not tell.  An id does that is made from the source's name, the text, and which of the equal
texts it is: writing the same rows again, in whatever order, gives the same ids.

A stream de-duplicates with state that a watermark bounds; a batch does so over all it reads.
Messages without an id all stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies of one row that a task makes.
CHUNK = 10_000
#: How long after a message its repetition is looked for.
WITHIN = "1 day"


def repeated(rows: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, with its number in ``copy``, from 1.

    Rows with many copies become several rows first, which are dealt to all tasks.
    """
    names = [c for c in rows.columns if c != times]
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / CHUNK).cast("long")))
    rows = rows.where(F.col(times) > 0).select(*names, times, chunk.alias("_chunk"))
    crowded = F.col(times) > CHUNK
    spread = rows.where(crowded).repartition("_chunk", *names)
    first = F.col("_chunk") * CHUNK + 1
    last = F.least(F.col("_chunk") * CHUNK + CHUNK, F.col(times))
    every = rows.where(~crowded).unionByName(spread)
    return every.select(*names, F.explode(F.sequence(first, last)).alias("copy"))


def identified(messages: DataFrame, source: str, *, value: str = "value") -> DataFrame:
    """``key, value`` with the message's id as ``key``; ``source`` names what the rows come from."""
    counted = messages.groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    name = F.sha2(F.concat_ws("\n", F.lit(source), F.base64(F.col("value").cast("binary"))), 256)
    key = F.concat_ws("-", name, F.col("copy").cast("string"))
    return repeated(counted, "n").select(key.alias("key"), "value")


def deduplicated(
    messages: DataFrame, *, key: str = "key", time: Column | None = None, within: str = WITHIN
) -> DataFrame:
    """The first message of each id; those without an id all stay.

    For a stream ``time`` says when a message was written.  Ids are kept in the state store until
    the watermark has passed them by ``within``, so a repetition that comes later than that counts
    again, and the state holds no more than the messages of that time.
    """
    known = messages.where(F.col(key).isNotNull())
    if messages.isStreaming:
        if time is None:
            raise ValueError("a stream needs the time of its messages")
        columns = messages.columns
        timed = known.withColumn("_written", time).withWatermark("_written", within)
        known = timed.dropDuplicatesWithinWatermark([key]).select(*columns)
    else:
        known = known.dropDuplicates([key])
    return known.unionByName(messages.where(F.col(key).isNull()))
