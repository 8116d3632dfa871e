"""Totals that follow the lake by increments.

Each run of silver has partial totals of its own: one row per group, with sums, counts, minima and
maxima, which merge.  A refresh scans only runs whose version is new; partials of runs that were
replaced go, those of all others are carried over.  The partials are a warehouse table, replaced
as a whole and at once, so a failed refresh leaves the old ones; they are small, a row per run
and group.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.contracts import Contract
from tamis.operators.mapping import Rule, apply_mapping
from tamis.plans.lake import SILVER, Lake
from tamis.plans.warehouse import materialise

#: How partial values of one group become one.
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_PART = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_RUN, _VERSION, _HELD = "_run", "_version", "_held"


@dataclass(frozen=True)
class Totals:
    """Group columns, and for each total the aggregate's name and what it aggregates.

    All are SQL text over the mapped rows: ``Totals({"Year": "substring(IDPeriode, 1, 4)"},
    {"TotalDeclaration": ("sum", "MontantDeclaration")})``.
    """

    by: Mapping[str, str]
    values: Mapping[str, tuple[str, str]]
    mapping: Mapping[str, Rule] = field(default_factory=dict)

    def __post_init__(self):
        if unknown := sorted({how for how, _ in self.values.values()} - _MERGE.keys()):
            raise ValueError(f"{unknown} do not merge; there are {sorted(_MERGE)}")

    def partial(self, silver: DataFrame, runs: DataFrame) -> DataFrame:
        """Partial totals of silver rows with their ``run``, and a row for each run without any."""
        rows = silver
        if self.mapping:
            rows = apply_mapping(silver, {_RUN: "run", **self.mapping})
        else:
            rows = silver.withColumnRenamed("run", _RUN)
        by = [F.expr(text).alias(name) for name, text in self.by.items()]
        parts = [_PART[how](F.expr(text)).alias(name) for name, (how, text) in self.values.items()]
        found = rows.groupBy(F.col(_RUN), *by).agg(*parts).withColumn(_HELD, F.lit(True))
        versions = runs.select(F.col("run").alias(_RUN), F.col("version").alias(_VERSION))
        # a run without accepted rows is known, too, and not scanned again
        return versions.join(found, _RUN, "left")

    def merged(self, partials: DataFrame) -> DataFrame:
        values = [_MERGE[how](F.col(name)).alias(name) for name, (how, _) in self.values.items()]
        return partials.where(F.col(_HELD)).groupBy(*self.by).agg(*values)


def new_runs(live: DataFrame, partials: DataFrame | None) -> DataFrame:
    """``run, version`` that the partials do not hold."""
    states = live.select("run", "version")
    if partials is None:
        return states
    known = partials.select(F.col(_RUN).alias("run"), F.col(_VERSION).alias("version")).distinct()
    return states.join(known, ["run", "version"], "left_anti")


def refresh_totals(
    spark: SparkSession,
    contract: Contract,
    lake: Lake,
    totals: Totals,
    table: str,
    *,
    path: str | None = None,
) -> DataFrame | None:
    """Bring the partials in ``table`` up to date with silver; returns the merged totals.

    None where there is no silver data.
    """
    live = lake.runs(spark, SILVER, contract)
    if live is None:
        return None
    partials = spark.table(table) if spark.catalog.tableExists(table) else None
    fresh = new_runs(live, partials)
    names = [r.run for r in fresh.collect()]  # what this refresh scans, not all runs
    if partials is None and not names:
        return None
    if names:
        rows = lake.rows(spark, SILVER, contract, names, keep=("run",))
        added = totals.partial(rows, fresh)
        if partials is not None:
            states = live.select(F.col("run").alias(_RUN), F.col("version").alias(_VERSION))
            kept = partials.join(states, [_RUN, _VERSION], "left_semi")
            added = kept.unionByName(added)
        partials = materialise(spark, added.coalesce(_files(spark)), table, path=path)
    return totals.merged(partials)


def _files(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism // 4)
