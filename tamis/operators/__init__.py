"""DataFrame-to-DataFrame operators.  None of them runs a job but ``split_join``, which looks for hot
keys, and ``numbered`` and ``ranked``, which write their rows once."""

from tamis.operators.envelope import from_envelope, summarise_errors, to_envelope
from tamis.operators.identity import deduplicated, identified
from tamis.operators.joins import split_join
from tamis.operators.mapping import apply_mapping, mapping_for
from tamis.operators.messages import decode_messages, rows_to_messages
from tamis.operators.position import numbered, ranked
from tamis.operators.promote import cast_errors, promote, promoted_rows
from tamis.operators.sql import run_sql, run_sql_file
from tamis.operators.star import period_dimension, period_dimension_of, star_total
from tamis.operators.validate import (
    checked_table,
    conforming_rows,
    message_errors,
    missing_flags,
    validate,
)

__all__ = [
    "apply_mapping",
    "cast_errors",
    "checked_table",
    "conforming_rows",
    "decode_messages",
    "deduplicated",
    "from_envelope",
    "identified",
    "mapping_for",
    "message_errors",
    "missing_flags",
    "numbered",
    "period_dimension",
    "period_dimension_of",
    "promote",
    "promoted_rows",
    "ranked",
    "rows_to_messages",
    "run_sql",
    "run_sql_file",
    "split_join",
    "star_total",
    "summarise_errors",
    "to_envelope",
    "validate",
]
