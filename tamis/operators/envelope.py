"""Error log records: ``key`` (always null) and ``value``, a JSON envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.contracts import Contract
from tamis.functions.json import error_envelope

ENVELOPE_SCHEMA = "original string, expectedSchema array<string>, error_type string"


def to_envelope(
    rejects: DataFrame, original: Column, contract: Contract, error_type: str | Column
) -> DataFrame:
    kind = F.lit(error_type) if isinstance(error_type, str) else error_type
    return rejects.select(
        F.lit(None).cast("string").alias("key"),
        error_envelope(original, contract, kind).alias("value"),
    )


def from_envelope(log: DataFrame, value: str = "value") -> DataFrame:
    """The three envelope fields as columns; ``value`` may be binary or string."""
    return log.select(
        F.inline(F.array(F.from_json(F.col(value).cast("string"), ENVELOPE_SCHEMA)))
    )


def summarise_errors(log: DataFrame, value: str = "value") -> DataFrame:
    """Records per error_type.  Only that one field is parsed out of the envelope."""
    kind = F.get_json_object(F.col(value).cast("string"), "$.error_type")
    return log.groupBy(kind.alias("error_type")).agg(F.count("*").alias("records"))
