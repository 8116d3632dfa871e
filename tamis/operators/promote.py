"""Typed promotion: bronze strings to silver types, with rejects tagged.

A row is rejected when any contract column holds text that does not cast; a
null stays null and is no error.  Narrow, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tamis.contracts import Contract
from tamis.functions.casts import caster
from tamis.functions.json import OK, TYPE_CAST_ERROR, error_envelope


class MissingColumn(ValueError):
    """The bronze data lacks a contract column."""


def _casts(
    bronze: DataFrame, contract: Contract, mode: str
) -> tuple[dict[str, Column], Column]:
    present = {name.lower() for name in bronze.columns}
    absent = [name for name in contract.names if name.lower() not in present]
    if absent:
        raise MissingColumn(f"{contract.topic}: bronze lacks columns {absent}")
    cast = caster(mode)
    typed = {f.name: cast(F.col(f.name), f.dataType) for f in contract.silver.fields}
    # Text to text cannot fail, so only the typed columns are tested.
    failures = [
        F.col(f.name).isNotNull() & typed[f.name].isNull()
        for f in contract.silver.fields
        if not isinstance(f.dataType, StringType)
    ]
    return typed, reduce(or_, failures, F.lit(False))


def _row_text(bronze: DataFrame, leave_out: Iterable[str] = ()) -> Column:
    out = set(leave_out)
    return F.to_json(F.struct(*[F.col(f"`{n}`") for n in bronze.columns if n not in out]))


def promote(
    bronze: DataFrame, contract: Contract, *, mode: str = "compat", keep: Iterable[str] = ()
) -> DataFrame:
    """``keep`` columns, silver columns (null on a reject), envelope (rejects only), outcome."""
    keep = list(keep)
    typed, failed = _casts(bronze, contract, mode)
    row = _row_text(bronze, leave_out=keep)
    return bronze.select(
        *keep,
        *[F.when(~failed, column).alias(name) for name, column in typed.items()],
        F.when(failed, error_envelope(row, contract, F.lit(TYPE_CAST_ERROR))).alias("envelope"),
        F.when(failed, F.lit(TYPE_CAST_ERROR)).otherwise(F.lit(OK)).alias("outcome"),
    )


def promoted_rows(bronze: DataFrame, contract: Contract, *, mode: str = "compat") -> DataFrame:
    """The rows whose every column casts, typed by the contract."""
    typed, failed = _casts(bronze, contract, mode)
    return bronze.where(~failed).select(*[c.alias(name) for name, c in typed.items()])


def cast_errors(bronze: DataFrame, contract: Contract, *, mode: str = "compat") -> DataFrame:
    """``key, value`` envelopes of the rows with a failed cast; original is the row as JSON."""
    _, failed = _casts(bronze, contract, mode)
    return bronze.where(failed).select(
        F.lit(None).cast("string").alias("key"),
        error_envelope(_row_text(bronze), contract, F.lit(TYPE_CAST_ERROR)).alias("value"),
    )
