"""Rows in a global order, with their position in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.session import scratch

#: ``monotonically_increasing_id`` keeps the row's number in the partition in the low bits.
_BITS = 33


def numbered(rows: DataFrame, name: str = "position") -> DataFrame:
    """The rows with their position, from 1, in the order that the frame has.

    That is the order of a global sort, such as that of a statement with ORDER BY.  Each task
    numbers its own rows; the rows of the partitions before are prefix sums of the partitions'
    counts, one row for each, so no window runs over all rows.  The numbered rows are written once
    to the shared folder: positions stay the same however often they are read.
    """
    place = scratch(rows.sparkSession, "numbered")
    rows.withColumn("_at", F.monotonically_increasing_id()).write.parquet(place)
    found = rows.sparkSession.read.parquet(place)
    part = F.shiftright("_at", _BITS)
    counts = found.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).collect()  # one per partition
    before, starts = 0, []
    for row in sorted(counts):
        starts.append((row["_part"], before))
        before += row["_n"]
    offsets = rows.sparkSession.createDataFrame(starts, "_part long, _before long")
    own = F.col("_at").bitwiseAND(F.lit((1 << _BITS) - 1))
    joined = found.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.select(*rows.columns, (F.col("_before") + own + 1).alias(name))


def ranked(rows: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """The rows with their position in a given order.

    Partitions are ranges of the order.  Rows that tie in it are ordered by a hash of all their
    columns and dealt to several ranges, so a value that a third of the rows share is not sorted
    in one task; only rows that are equal altogether come in any order.
    """
    columns = rows.columns
    tied = rows.withColumn("_tie", F.xxhash64(*columns)).withColumn("_row", F.monotonically_increasing_id())
    by = [*order, F.col("_tie"), F.col("_row")]
    dealt = tied.repartitionByRange(*by).sortWithinPartitions(*by)
    return numbered(dealt.select(*columns), name)
