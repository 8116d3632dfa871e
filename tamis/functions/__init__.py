"""Column expressions: pure functions from columns to columns."""

from tamis.functions.casts import cast_compat, cast_strict, caster
from tamis.functions.json import error_envelope, extra_fields, outcome, parsed_message

__all__ = [
    "cast_compat",
    "cast_strict",
    "caster",
    "error_envelope",
    "extra_fields",
    "outcome",
    "parsed_message",
]
