"""Records of delimited text files whose quoted cells hold line breaks.

Spark's multi-line CSV reader takes a whole file as one task.  Here the lines
are read split by split and records are put together afterwards, so one file of
any size uses the whole cluster.

Whether a line starts inside a quoted cell depends on all lines before it.  A
line either keeps that state, flips it, or sets it; chains of such steps compose.
A first pass over the text folds each split into one row, without a shuffle: the
state it ends in for either state it may start in.  The rows are chained per file.
A second pass knows the state each split starts in and writes its records; only parts
of records that cross splits are shuffled.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamis.session import scratch

# A quoted cell, up to its closing quote.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
# A line that starts outside quotes and ends inside a quoted cell.
ENDS_OPEN = rf'^(?:(?:{QUOTED}"[^,]*+|[^",][^,]*+)?+,)*+{QUOTED}$'
# A line the CSV reader skips.
BLANK = r"^[\x00-\x20]*$"


class UnclosedQuote(ValueError):
    """A file's last quoted cell has no end, so that its last record is the rest of the file."""


def header_names(header: str) -> list[str]:
    """The cells of a header record."""
    return next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline="")), [])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place, and the state after each for a start outside and inside quotes."""
    line = F.col("value")
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        line.alias("line"),
        line.rlike(ENDS_OPEN).cast("byte").alias("outside"),
        F.concat(F.lit('"'), line).rlike(ENDS_OPEN).cast("byte").alias("inside"),
    )


def _states(outside: np.ndarray, inside: np.ndarray, start: int) -> np.ndarray:
    """The state before each line and after the last one."""
    flips = np.cumsum(outside > inside)
    at = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
    since = flips - np.where(at >= 0, flips[at], 0)
    after = np.where(at >= 0, outside[at], start) ^ (since & 1)
    return np.concatenate([[start], after])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The rows of each split in a batch."""
    place = list(zip(batch.column("file").to_pylist(), batch.column("split").to_pylist()))
    start = 0
    for n in range(1, len(place) + 1):
        if n == len(place) or place[n] != place[start]:
            yield *place[start], batch.slice(start, n - start)
            start = n


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split, see ``_SPLIT``."""
    current: dict | None = None

    def row() -> pa.RecordBatch:
        values = [[current[name]] for name in _SPLIT]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(values, _SPLIT.values())], list(_SPLIT)
        )

    for batch in batches:
        for file, split, run in _runs(batch):
            if current is None or (current["file"], current["split"]) != (file, split):
                if current:
                    yield row()
                current = {"file": file, "split": split, "to_0": 0, "to_1": 1, "starts_0": False}
                current |= {"starts_1": False, "broken": False, "blank": False, "header": None}
                parts, closed = [], split != 0
            steps = [run.column(c).to_numpy().astype(np.int64) for c in ("outside", "inside")]
            for start in (0, 1):
                states = _states(*steps, current[f"to_{start}"])
                current[f"starts_{start}"] |= bool((states[:-1] == 0).any())
                current[f"to_{start}"] = int(states[-1])
                if start == 0 and not closed:
                    # the header goes up to the first line that ends outside
                    ends = np.flatnonzero(states[1:] == 0)
                    stop = int(ends[0]) + 1 if len(ends) else len(states) - 1
                    parts += run.column("line").slice(0, stop).to_pylist()
                    if len(ends):
                        closed, current["header"] = True, "\n".join(parts)
            current["broken"] |= bool(steps[0].any())
            current["blank"] |= any(run.column("blank").to_pylist())
    if current:
        yield row()


_SPLIT = {
    "file": pa.string(),
    "split": pa.int64(),
    "to_0": pa.int64(),
    "to_1": pa.int64(),
    "starts_0": pa.bool_(),
    "starts_1": pa.bool_(),
    "broken": pa.bool_(),
    "blank": pa.bool_(),
    "header": pa.string(),
}


def fold_splits(spark: SparkSession, path: str) -> DataFrame:
    """One row per split: its effect on the state, whether a record starts in it, whether lines
    end inside quotes or are blank, and a first split's header record.  Written once."""
    lines = _lines(spark, path).select(
        "file",
        "split",
        F.when(F.col("split") == 0, F.col("line")).alias("line"),
        "outside",
        "inside",
        F.col("line").rlike(BLANK).alias("blank"),
    )
    kind = (
        "file string, split long, to_0 long, to_1 long, starts_0 boolean, starts_1 boolean,"
        " broken boolean, blank boolean, header string"
    )
    target = scratch(spark, "splits")
    lines.mapInArrow(_folded, kind).write.parquet(target)
    return spark.read.schema(kind).parquet(target)


def _chained(splits: DataFrame) -> DataFrame:
    """``start``, the state that each split starts in, and the ``owner`` of its first lines, the
    last split before it in which a record starts."""
    upto = Window.partitionBy("file").orderBy("split")
    # a split keeps, flips or sets the state; the state after it follows from the last set one
    sets = F.when(F.col("to_0") == F.col("to_1"), F.col("to_0"))
    flips = F.sum((F.col("to_0") > F.col("to_1")).cast("int")).over(upto)
    rows = splits.withColumn("flips", flips).withColumn("sets", sets)
    base = F.last(F.col("sets") + F.col("flips"), ignorenulls=True).over(upto)
    after = F.pmod(F.coalesce(base, F.lit(0)) + F.col("flips"), F.lit(2))
    rows = rows.withColumn("after", after)
    rows = rows.withColumn("start", F.coalesce(F.lag("after").over(upto), F.lit(0)))
    starts = F.when(F.col("start") == 0, F.col("starts_0")).otherwise(F.col("starts_1"))
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(starts, F.col("split")), ignorenulls=True).over(before)
    return rows.withColumn("owner", owner)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records; ``owner`` is set for the parts of records that cross splits."""
    place, state, held, first, owner = None, 0, [], False, None
    rows: list[tuple[str, int, int | None, str]] = []

    def close(ended: bool) -> None:
        """Hand on the held lines: a whole record, or a part that goes on in other splits."""
        nonlocal held, first, owner
        if held and not first:
            rows.append((*place, None if ended and owner is None else place[1] if owner is None else owner, "\n".join(held)))
        held, owner = [], None
        if ended:
            first = False

    def flush() -> pa.RecordBatch:
        nonlocal rows
        columns = list(zip(*rows)) or [()] * 4
        rows = []
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["file", "split", "owner", "record"]
        )

    for batch in batches:
        for file, split, run in _runs(batch):
            if place != (file, split):
                if place:
                    close(state == 0)
                place, state = (file, split), run.column("start")[0].as_py()
                first = split == 0  # the header is no row
                owner = run.column("owner")[0].as_py() if state else None
            steps = [run.column(c).to_numpy().astype(np.int64) for c in ("outside", "inside")]
            states = _states(*steps, state)
            for line, after in zip(run.column("line").to_pylist(), states[1:].tolist()):
                held.append(line)
                if after == 0:
                    close(True)
            state = int(states[-1])
        yield flush()
    if place:
        close(state == 0)
    yield flush()


def delimited_records(spark: SparkSession, path: str, splits: DataFrame) -> DataFrame:
    """``file`` and ``record`` of all records but the files' headers; ``splits`` as folded."""
    chained = _chained(splits)
    ends = chained.groupBy("file").agg(F.max_by("after", "split").alias("after"))
    if broken := ends.where("after = 1").limit(5).collect():
        raise UnclosedQuote("unclosed quote in " + ", ".join(sorted(r.file for r in broken)))
    known = chained.select("file", "split", "start", "owner")
    lines = _with_states(_lines(spark, path), known)
    kind = "file string, split long, owner long, record string"
    target = scratch(spark, "records")  # read twice, put together once
    columns = ("file", "split", "line", "outside", "inside", "start", "owner")
    lines.select(*columns).mapInArrow(_assembled, kind).write.parquet(target)
    found = spark.read.schema(kind).parquet(target)
    parts = F.sort_array(F.collect_list(F.struct("split", "record")))
    crossing = (
        found.where("owner IS NOT NULL")
        .groupBy("file", "owner")  # the parts of one record
        .agg(F.array_join(parts["record"], "\n").alias("record"))
    )
    whole = found.where("owner IS NULL")
    return whole.select("file", "record").unionByName(crossing.select("file", "record"))


#: Splits or files whose states or headers may be broadcast.
_SMALL = 200_000


def small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= _SMALL else rows


def _with_states(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """The lines with their split's state, those of a split together and in order.

    The states of up to ``_SMALL`` splits are broadcast and the lines stay where they are; with
    more, lines are dealt by split and put in order again.
    """
    place = ["file", "split"]
    if splits.count() <= _SMALL:
        return lines.join(F.broadcast(splits), place)
    numbered = lines.withColumn("number", F.monotonically_increasing_id())  # rises in a split
    return numbered.join(splits, place).repartition(*place).sortWithinPartitions(*place, "number")
