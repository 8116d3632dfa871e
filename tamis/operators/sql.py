"""SQL mapping: register frames as views named after their topic, run one statement."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, views: Mapping[str, DataFrame], text: str) -> DataFrame:
    """The statement's result.  A trailing semicolon is fine, a second statement is not.

    The views are gone afterwards, and what they hid is back: a result is analysed at once.
    """
    hidden = {name: _temp_view(spark, name) for name in views}
    try:
        for name, frame in views.items():
            frame.createOrReplaceTempView(name)
        return spark.sql(text)
    finally:
        for name, frame in hidden.items():
            spark.catalog.dropTempView(name)
            if frame is not None:
                frame.createOrReplaceTempView(name)


def _temp_view(spark: SparkSession, name: str) -> DataFrame | None:
    try:
        return spark.table(name) if spark.catalog.getTable(name).isTemporary else None
    except AnalysisException:
        return None


def run_sql_file(
    spark: SparkSession, views: Mapping[str, DataFrame], path: str | Path
) -> DataFrame:
    return run_sql(spark, views, sql_text(path))


def sql_text(path: str | Path) -> str:
    """The text of a SQL file that must exist where the driver program runs."""
    path = Path(path)
    if not path.is_file():
        raise ValueError(f"SQL file {str(path)!r} not found")
    return path.read_text(encoding="utf-8")
