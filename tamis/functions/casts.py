"""String-to-typed casts that yield NULL on bad text, whatever the ANSI setting.

``strict`` is ``try_cast``.  ``compat`` also accepts what the non-ANSI integer
cast accepts: decimal text, cut at the point (``12.7`` is 12, ``-.5`` is 0,
``.`` is 0).  Both agree for every non-integral type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, StringType

# The blank characters a string-to-number cast trims, as a regex class.
_BLANK = r"[\x00-\x20\x7F]*"
_WHOLE_TEXT = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}\z"
# ``$`` would also match before a final line end such as U+0085.
# Sign and digits before a decimal point; only digits may follow it.
_POINT_TEXT = rf"^{_BLANK}([+-]?[0-9]*)[.][0-9]*{_BLANK}\z"
# How every text that a float can be read from starts.
_FLOAT_START = rf"^{_BLANK}[+-]?[0-9.nNiI]"


def cast_strict(text: Column, to: DataType) -> Column:
    """``try_cast``, kept from hopeless texts.

    A failing ``try_cast`` took over ten times as long as a pattern test when
    measured; a source of bad texts must not slow the job.
    """
    if isinstance(to, StringType):
        return text
    if isinstance(to, IntegralType):
        return F.when(text.rlike(_WHOLE_TEXT), text.try_cast(to))
    if isinstance(to, FloatType | DoubleType):
        return F.when(text.rlike(_FLOAT_START), text.try_cast(to))
    return text.try_cast(to)


def cast_compat(text: Column, to: DataType) -> Column:
    if not isinstance(to, IntegralType):
        return cast_strict(text, to)
    digits = F.regexp_extract(text, _POINT_TEXT, 1)
    cut = F.when(digits.isin("", "+", "-"), F.lit(0).cast(to)).otherwise(digits.try_cast(to))
    return F.when(text.rlike(_WHOLE_TEXT), text.try_cast(to)).when(text.rlike(_POINT_TEXT), cut)


def caster(mode: str) -> Callable[[Column, DataType], Column]:
    try:
        return {"compat": cast_compat, "strict": cast_strict}[mode]
    except KeyError:
        raise ValueError(f"cast mode must be 'compat' or 'strict', not {mode!r}") from None
