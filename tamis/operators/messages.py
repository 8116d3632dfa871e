"""Rows to topic messages and back to text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_to_messages(rows: DataFrame) -> DataFrame:
    """``key`` (null) and ``value``: each row as a JSON object of strings.

    A null cell is left out of its message; readers that must keep an empty
    cell as an empty string deliver it as one (see ``sources.files``).
    """
    fields = [F.col(f"`{name}`").cast("string").alias(name) for name in rows.columns]
    return rows.select(
        F.lit(None).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def decode_messages(
    topic: DataFrame, *, value: str = "value", keep: Iterable[str] = ()
) -> DataFrame:
    """The message bytes as UTF-8 text in ``json_string``."""
    return topic.select(*keep, F.col(value).cast("string").alias("json_string"))
