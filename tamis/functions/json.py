"""JSON expressions: the parsed message, its outcome, and the error envelope."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.contracts import Contract

# The outcomes a message or bronze row can have.  All but the
# first are the ``error_type`` texts of the error log.
OK = "ok"
MISSING_COLUMNS = "missing_columns"
EXTRA_COLUMNS = "extra_columns"
TYPE_CAST_ERROR = "type_cast_error"


def names_of(contract: Contract) -> Column:
    return F.array(*[F.lit(name) for name in contract.names])


def parsed_columns(text: Column, contract: Contract, *, keys: bool = True) -> list[Column]:
    """``original, data, keys`` of a message as plain columns; ``keys`` is optional."""
    parts = [text.alias("original"), F.from_json(text, contract.bronze).alias("data")]
    return [*parts, F.json_object_keys(text).alias("keys")] if keys else parts


def parsed_message(text: Column, contract: Contract, *, keys: bool = True) -> Column:
    """The generator of ``original, data, keys`` for one message; yields exactly one row.

    A generator and not plain columns, because Catalyst pushes filters below a
    projection and then copies ``from_json`` into every field test, one parse per
    contract field.  Nothing that uses a generator's output is pushed below it,
    so each message is parsed once.
    """
    return F.inline(F.array(F.struct(*parsed_columns(text, contract, keys=keys))))


def is_missing(contract: Contract) -> Column:
    """Whether a contract field of ``data`` is absent or null; malformed text has none."""
    return reduce(or_, [F.col("data")[name].isNull() for name in contract.names])


def extra_fields(contract: Contract) -> Column:
    """The keys outside the contract; null for text that is no JSON object."""
    return F.array_except("keys", names_of(contract))


def outcome(contract: Contract) -> Column:
    """ok, extra_columns or missing_columns, of the columns ``data`` and ``keys``."""
    return (
        F.when(is_missing(contract), F.lit(MISSING_COLUMNS))
        # No field is missing, so this many keys are just the contract's.
        .when(F.size("keys") == len(contract.names), F.lit(OK))
        .when(F.size(extra_fields(contract)) > 0, F.lit(EXTRA_COLUMNS))
        .otherwise(F.lit(OK))
    )


def error_envelope(original: Column, contract: Contract, error_type: Column) -> Column:
    """JSON text ``{original, expectedSchema, error_type}``; a NULL original is left out."""
    return F.to_json(
        F.struct(
            original.alias("original"),
            names_of(contract).alias("expectedSchema"),
            error_type.alias("error_type"),
        )
    )
