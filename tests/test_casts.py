from __future__ import annotations

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

from tamis.functions.casts import cast_compat, cast_strict, caster

GOLDEN = [
    ("12", 12, 12),
    (" 12 ", 12, 12),
    ("+7", 7, 7),
    ("12.7", 12, None),
    ("-0.9", 0, None),
    (".5", 0, None),
    ("-.5", 0, None),
    ("5.", 5, None),
    (".", 0, None),
    ("+", None, None),
    ("-", None, None),
    ("1.2.3", None, None),
    ("1e3", None, None),
    ("1_000", None, None),
    ("0x1F", None, None),
    ("12f", None, None),
    ("NaN", None, None),
    ("abc", None, None),
    ("", None, None),
    ("3000000000", None, None),
    ("99999999999.5", None, None),
    ("2147483647.9", 2147483647, None),
    ("-2147483648.9", -2147483648, None),
    (" 12.7\t", 12, None),
    ("1 .5", None, None),
    ("\x7f12.7\x00", 12, None),
    ("12.7\x85", None, None),
    ("12.7\u2028", None, None),
    (".5\u2029", None, None),
    (None, None, None),
]


def _casts(spark, texts, cast, to):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = rows.select("id", cast(F.col("t"), to).alias("v")).collect()
    return [r.v for r in sorted(got, key=lambda r: r.id)]


def test_strict_equals_try_cast(spark):
    texts = [t for t, _, _ in GOLDEN] + ["\x0012\x7f", "1 2", "١٢", "9" * 30, "-0", "+ 5"]
    for to in (IntegerType(), LongType(), ByteType(), FloatType(), DoubleType()):
        want = _casts(spark, texts, lambda c, t: c.try_cast(t), to)
        assert list(map(repr, _casts(spark, texts, cast_strict, to))) == list(map(repr, want))


def test_golden_integers(spark):
    texts = [t for t, _, _ in GOLDEN]
    assert _casts(spark, texts, cast_compat, IntegerType()) == [c for _, c, _ in GOLDEN]
    assert _casts(spark, texts, cast_strict, IntegerType()) == [s for _, _, s in GOLDEN]


_DIGITS = st.text("0123456789", max_size=12)
_NUMBERS = st.builds(
    lambda *parts: "".join(parts),
    st.sampled_from(["", "", " ", "\t", "\n\x0b", "\x00", "\x7f", "\x85", " "]),
    st.sampled_from(["", "", "+", "-", "+-"]),
    _DIGITS,
    st.sampled_from(["", ".", ".", ". ", "e", "x"]),
    _DIGITS,
    st.sampled_from(["", "", " ", "\x1f", "\x7f", "f", ".", " "]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(_NUMBERS | st.text(max_size=8), min_size=100, max_size=200))
@pytest.mark.parametrize("to", [IntegerType(), LongType(), ShortType(), ByteType()])
def test_compat_equals_the_non_ansi_cast(spark, to, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = _casts(spark, texts, cast_compat, to)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = _casts(spark, texts, lambda c, t: c.cast(t), to)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert dict(zip(texts, got, strict=True)) == dict(zip(texts, want, strict=True))


_FLOATS = st.builds(
    lambda *parts: "".join(parts),
    st.sampled_from(["", "", " ", "\t", "\x00", "\x7f", "x"]),
    st.sampled_from(["", "", "+", "-", "--"]),
    st.sampled_from(["NaN", "nan", "Infinity", "inf", "INF", "0x1p3", "1", "12", ".", ".5", "5."]),
    st.sampled_from(["", "", "e3", "E-2", "f", "d", ".25", "_0", " "]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(_FLOATS | st.text(max_size=6), min_size=100, max_size=200))
@pytest.mark.parametrize("to", [FloatType(), DoubleType()])
def test_floats_equal_the_non_ansi_cast(spark, to, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = _casts(spark, texts, cast_compat, to)
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = _casts(spark, texts, lambda c, t: c.cast(t), to)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert list(map(repr, got)) == list(map(repr, want))


def test_floats(spark):
    texts = ["12.7", " 1e3 ", "16777217", "Infinity", "NaN", "1e39", "x", "", "12f", None]
    got = _casts(spark, texts, cast_compat, FloatType())
    assert got[:4] == [pytest.approx(12.7), 1000.0, 16777216.0, math.inf]
    assert math.isnan(got[4]) and got[5] == math.inf
    assert got[6:8] == [None, None] and got[8] == 12.0 and got[9] is None
    assert _casts(spark, ["12.7"], cast_compat, DoubleType()) == [12.7]


def test_text_is_left_alone(spark):
    assert _casts(spark, [" a ", "", None], cast_compat, StringType()) == [" a ", "", None]


def test_unknown_mode():
    with pytest.raises(ValueError, match="loose"):
        caster("loose")
