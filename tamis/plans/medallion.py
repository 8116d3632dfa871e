"""Messages to result as one plan, without tables in between."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.contracts import Contract
from tamis.functions.json import MISSING_COLUMNS
from tamis.operators.mapping import Rule, apply_mapping
from tamis.operators.promote import promote, promoted_rows
from tamis.operators.sql import run_sql
from tamis.operators.validate import checked_table, conforming_rows


def medallion_total(
    spark: SparkSession,
    messages: DataFrame,
    contract: Contract,
    mapping: Mapping[str, Rule],
    sql: str,
    *,
    mode: str = "compat",
) -> DataFrame:
    """Check, promote, map, then run ``sql`` over the view named after the topic."""
    silver = promoted_rows(conforming_rows(messages, contract), contract, mode=mode)
    return run_sql(spark, {contract.topic: apply_mapping(silver, mapping)}, sql)


def medallion_errors(messages: DataFrame, contract: Contract, *, mode: str = "compat") -> DataFrame:
    """``key, value`` envelopes of the check and of the promotion, from one parse.

    A message with extra keys can appear twice, once per stage.
    """
    stages = checked_table(messages, contract).withColumnsRenamed(
        {"envelope": "check_envelope", "outcome": "check_outcome"}
    )
    kept = ["check_envelope", "check_outcome"]
    both = promote(stages, contract, mode=mode, keep=kept).select(
        F.array_compact(
            F.array(
                "check_envelope",
                F.when(F.col("check_outcome") != MISSING_COLUMNS, F.col("envelope")),
            )
        ).alias("envelopes")
    )
    return both.select(
        F.lit(None).cast("string").alias("key"), F.explode("envelopes").alias("value")
    )
