"""The contract check: every message is ok, extra_columns or missing_columns.

The check is closed-world.  A contract field that is absent or null makes the
message ``missing_columns``, which wins over ``extra_columns``; text that is not
a JSON object has no fields and is missing too.  Messages with extra keys still
yield a row, cut to the contract, and an error envelope.

All operators here are narrow: no shuffle, one parse per message.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.contracts import Contract
from tamis.functions.json import (
    EXTRA_COLUMNS,
    MISSING_COLUMNS,
    OK,
    error_envelope,
    extra_fields,
    is_missing,
    outcome,
    parsed_columns,
    parsed_message,
)

#: Outcomes whose messages become bronze rows, and those that reach the error log.
LANDED = (OK, EXTRA_COLUMNS)
LOGGED = (MISSING_COLUMNS, EXTRA_COLUMNS)


def _parsed(
    messages: DataFrame, contract: Contract, value: str, keep: Iterable[str], keys: bool = True
) -> DataFrame:
    text = F.col(value).cast("string")
    return messages.select(*keep, parsed_message(text, contract, keys=keys))


def validate(
    messages: DataFrame, contract: Contract, *, value: str = "value", keep: Iterable[str] = ()
) -> DataFrame:
    """``keep`` columns plus outcome, extra_fields, original and the parsed data struct."""
    keep = list(keep)
    return _parsed(messages, contract, value, keep).select(
        *keep,
        outcome(contract).alias("outcome"),
        extra_fields(contract).alias("extra_fields"),
        "original",
        "data",
    )


def conforming_rows(
    messages: DataFrame,
    contract: Contract,
    *,
    outcomes: Iterable[str] = LANDED,
    value: str = "value",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Contract columns, all strings, of the messages with one of ``outcomes``."""
    keep, outcomes = list(keep), set(outcomes)
    if outcomes == set(LANDED):  # the keys do not matter then, so they are not read
        complete = _parsed(messages, contract, value, keep, keys=False)
        return complete.where(~is_missing(contract)).select(*keep, "data.*")
    checked = validate(messages, contract, value=value, keep=keep)
    return checked.where(F.col("outcome").isin(*sorted(outcomes))).select(*keep, "data.*")


def message_errors(
    messages: DataFrame,
    contract: Contract,
    *,
    outcomes: Iterable[str] = LOGGED,
    value: str = "value",
) -> DataFrame:
    """``key, value`` error envelopes of the messages with one of ``outcomes``."""
    outcomes = set(outcomes)
    if outcomes == {MISSING_COLUMNS}:
        found = _parsed(messages, contract, value, [], keys=False)
        found = found.where(is_missing(contract))
        kind = F.lit(MISSING_COLUMNS)
    else:
        found = validate(messages, contract, value=value)
        found = found.where(F.col("outcome").isin(*sorted(outcomes)))
        kind = F.col("outcome")
    return found.select(
        F.lit(None).cast("string").alias("key"),
        error_envelope(F.col("original"), contract, kind).alias("value"),
    )


def checked_table(
    messages: DataFrame, contract: Contract, *, value: str = "value", unfiltered: bool = False
) -> DataFrame:
    """Both legs in one row set: contract columns, envelope (unless ok) and outcome.

    Written partitioned by outcome, one pass over the topic yields the bronze
    rows and the error log together.  ``unfiltered`` promises that the table is
    written as it is; it is then parsed by plain columns, which are faster as
    long as no filter is pushed below them.
    """
    if unfiltered:
        text = F.col(value).cast("string")
        parsed = messages.select(*parsed_columns(text, contract))
    else:
        parsed = _parsed(messages, contract, value, [])
    return parsed.select("original", "data", outcome(contract).alias("outcome")).select(
        "data.*",
        F.when(
            F.col("outcome") != OK,
            error_envelope(F.col("original"), contract, F.col("outcome")),
        ).alias("envelope"),
        "outcome",
    )


def missing_flags(
    messages: DataFrame, contract: Contract, *, value: str = "value", keep: Iterable[str] = ()
) -> DataFrame:
    """One boolean ``missing_<field>`` per contract field, plus has_missing and has_extra."""
    keep = list(keep)
    return _parsed(messages, contract, value, keep).select(
        *keep,
        *[F.col("data")[name].isNull().alias(f"missing_{name}") for name in contract.names],
        is_missing(contract).alias("has_missing"),
        (F.coalesce(F.size(extra_fields(contract)), F.lit(0)) > 0).alias("has_extra"),
    )
