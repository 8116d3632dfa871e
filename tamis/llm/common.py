"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.session import scratch

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = str.maketrans(UPPER, LOWER)

#: Rows of a small table that may be broadcast; a larger one is joined by a shuffle.
SMALL_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: lineage ends here."""
    path = scratch(frame.sparkSession, name)
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def small(frame: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """The (settled) table, marked for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(frame) if frame.count() <= rows else frame
