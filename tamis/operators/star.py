"""Star schema: totals of a fact by dimension attributes, and the period dimension."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators.joins import split_join


@dataclass(frozen=True)
class Dimension:
    """A dimension, the fact column that refers to it, its key and wanted attributes.

    The result names an attribute ``prefix`` and its own name.
    """

    frame: DataFrame
    fact_key: str
    key: str
    attributes: Sequence[str] = field(default_factory=tuple)
    prefix: str = ""

    @property
    def names(self) -> list[str]:
        return [f"{self.prefix}{name}" for name in self.attributes]


def _is_small(frame: DataFrame) -> bool:
    """Whether Spark's own estimate is under the session's bound for a broadcast."""
    bound = frame.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= bound


def star_total(
    fact: DataFrame,
    measure: str,
    dimensions: Sequence[Dimension],
    *,
    total: str = "total",
    by: Sequence[str] = (),
    how: str = "left",
    split_hot: bool = True,
) -> DataFrame:
    """``sum(measure)`` by fact columns ``by`` and the dimensions' attributes.

    Dimensions below ``spark.sql.autoBroadcastJoinThreshold`` are joined first: Spark
    broadcasts them, so the fact is summed up in place and only groups are shuffled.
    For larger dimensions the fact is then summed by their keys and what is known so
    far, which shrinks a hot key to one row per task and combination.  Keys that stay hot
    because their combinations are many are joined apart from the rest (``split_join``);
    a table bucketed by the key is not shuffled, and then nothing is split.  Columns are
    numbered inside, so equal names in the fact and the dimensions do no harm; equal
    names in the result are refused.
    """
    result = [*by, *(name for d in dimensions for name in d.names), total]
    if twice := sorted({name for name in result if result.count(name) > 1}):
        raise ValueError(f"result columns {twice} would appear twice; give a prefix")
    attributes = [[f"a{n}_{i}" for i in range(len(d.attributes))] for n, d in enumerate(dimensions)]
    groups = [f"b{i}" for i in range(len(by))]
    rows = fact.select(
        *(F.col(name).alias(group) for name, group in zip(by, groups, strict=True)),
        *(F.col(d.fact_key).alias(f"k{n}") for n, d in enumerate(dimensions)),
        F.col(measure).alias("m"),
    )

    def joined(rows: DataFrame, n: int) -> DataFrame:
        d = dimensions[n]
        own = zip(d.attributes, attributes[n], strict=True)
        side = d.frame.select(F.col(d.key).alias("key"), *(F.col(x).alias(y) for x, y in own))
        # with nothing else to group by, a key is one row after the sum and can't be hot
        if n in large and split_hot and (groups or len(dimensions) > 1):
            both = split_join(rows, side, f"k{n}", "key", how, keys_of=keys.select(f"k{n}"))
        else:
            both = rows.join(side, F.col(f"k{n}") == F.col("key"), how)
        return both.drop("key", f"k{n}")

    keys = rows
    small = [n for n, d in enumerate(dimensions) if _is_small(d.frame)]
    large = [n for n in range(len(dimensions)) if n not in small]
    known = list(groups)
    for n in small:
        rows = joined(rows, n)
        known += attributes[n]
    if large:
        rows = rows.groupBy(*known, *(f"k{n}" for n in large)).agg(F.sum("m").alias("m"))
        for n in large:
            rows = joined(rows, n)
    ordered = [*groups, *(name for own in attributes for name in own)]
    return rows.groupBy(*ordered).agg(F.sum("m")).toDF(*result)


def _periods(bounds: DataFrame) -> DataFrame:
    months = F.sequence(
        F.trunc("first", "month"), F.trunc("last", "month"), F.expr("INTERVAL 1 MONTH")
    )
    return bounds.select(F.explode(months).alias("month_start")).select(
        F.date_format("month_start", "yyyyMM").cast("int").alias("idperiod"),
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
    )


def period_dimension(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row (idperiod, year, month) per month between two ISO dates, inclusive."""
    dates = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return _periods(dates)


def period_dimension_of(fact: DataFrame, date: Column) -> DataFrame:
    """The period dimension covering every month from the fact's first to its last date."""
    first, last = F.min(date).cast("date"), F.max(date).cast("date")
    return _periods(fact.agg(first.alias("first"), last.alias("last")))
