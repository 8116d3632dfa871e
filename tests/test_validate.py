from __future__ import annotations

import json
import string
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamis.contracts import CONTRACTS
from tamis.operators.validate import (
    checked_table,
    conforming_rows,
    message_errors,
    missing_flags,
    validate,
)
from tests.conftest import AB, optimized, physical

OK, EXTRA, MISSING = "ok", "extra_columns", "missing_columns"

TRUTH = [
    ('{"A":"1","B":"x"}', OK, ("1", "x")),
    ('{"A":1.50,"B":true}', OK, ("1.5", "true")),
    ('{"A":{"q":1},"B":[1,2]}', OK, ('{"q":1}', "[1,2]")),
    ('{"A":"","B":""}', OK, ("", "")),
    (' {"B":"x","A":"1"} ', OK, ("1", "x")),
    ('{"A":"1","B":"x"} junk', OK, ("1", "x")),
    ('{"A":"1","A":"2","B":"x"}', OK, ("2", "x")),
    ('{"A":"1","B":"x","C":"z"}', EXTRA, ("1", "x")),
    ('{"A":"1","B":"x","C":null}', EXTRA, ("1", "x")),
    ('{"A":"1","B":"x","C":"z"} junk', EXTRA, ("1", "x")),
    ('{"A":null,"B":"x"}', MISSING, None),
    ('{"A":"1"}', MISSING, None),
    ("{}", MISSING, None),
    ('{"a":"1","B":"x"}', MISSING, None),
    ('{"A":"1","C":"z"}', MISSING, None),
    ('{"A":"1","B":"x"', MISSING, None),
    ('{"A":"1","B":tru}', MISSING, None),
    ("hello", MISSING, None),
    ("5", MISSING, None),
    ("", MISSING, None),
    ("[1]", MISSING, None),
    ('[{"A":"1","B":"x"}]', MISSING, None),
    (None, MISSING, None),
]


def _topic(spark, texts):
    rows = [(i, None if t is None else t.encode()) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id int, value binary")


def test_truth_table(spark):
    topic = _topic(spark, [text for text, _, _ in TRUTH])
    got = {r.id: r for r in validate(topic, AB, keep=["id"]).collect()}
    assert len(got) == len(TRUTH)
    for i, (text, outcome, row) in enumerate(TRUTH):
        assert got[i].outcome == outcome, text
        assert got[i].original == text
        if row:
            assert tuple(got[i].data) == row
    rows = conforming_rows(topic, AB, keep=["id"]).collect()
    assert {(r.id, r.A, r.B) for r in rows} == {
        (i, *row) for i, (_, _, row) in enumerate(TRUTH) if row
    }


def test_truth_table_without_ansi(spark):
    topic = _topic(spark, [text for text, _, _ in TRUTH])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = {r.id: r.outcome for r in validate(topic, AB, keep=["id"]).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert [got[i] for i in range(len(TRUTH))] == [outcome for _, outcome, _ in TRUTH]


def test_legs_cover_every_message_once(spark):
    topic = _topic(spark, [text for text, _, _ in TRUTH])
    count = {o: sum(outcome == o for _, outcome, _ in TRUTH) for o in (OK, EXTRA, MISSING)}
    assert conforming_rows(topic, AB, outcomes=[OK]).count() == count[OK]
    assert conforming_rows(topic, AB).count() == count[OK] + count[EXTRA]
    assert message_errors(topic, AB, outcomes=[MISSING]).count() == count[MISSING]
    assert message_errors(topic, AB).count() == count[MISSING] + count[EXTRA]
    table = checked_table(topic, AB)
    assert table.columns == ["A", "B", "envelope", "outcome"]
    assert table.count() == len(TRUTH)
    assert table.where("(outcome = 'ok') <> (envelope IS NULL)").count() == 0


def test_envelopes_hold_the_raw_text(spark):
    values = message_errors(_topic(spark, ['{"A":"1","B":"é","C":2}', "bad", None]), AB)
    got = [json.loads(r.value) for r in values.collect()]
    assert all(r.key is None for r in values.collect())
    schema = ["A", "B"]
    assert got == [
        {"original": '{"A":"1","B":"é","C":2}', "expectedSchema": schema, "error_type": EXTRA},
        {"original": "bad", "expectedSchema": schema, "error_type": MISSING},
        {"expectedSchema": schema, "error_type": MISSING},
    ]


def test_flags(spark):
    topic = _topic(spark, ['{"A":"1","C":2}', '{"A":"1","B":"2"}', "bad"])
    flags = missing_flags(topic, AB, keep=["id"]).orderBy("id").collect()
    assert [tuple(r)[1:] for r in flags] == [
        (False, True, True, True),
        (False, False, False, False),
        (True, True, True, False),
    ]


def _plain(topic):
    """The check written out field by field over a struct and a map parse."""
    parsed = topic.select(
        "id",
        F.from_json(F.col("value").cast("string"), AB.bronze).alias("d"),
        F.from_json(F.col("value").cast("string"), "map<string,string>").alias("m"),
    )
    extra = F.expr("exists(map_keys(m), k -> k NOT IN ('A', 'B'))")
    missing = F.col("d.A").isNull() | F.col("d.B").isNull()
    outcome = F.when(missing, MISSING).when(F.coalesce(extra, F.lit(False)), EXTRA).otherwise(OK)
    return parsed.select("id", outcome.alias("outcome"))


_names = st.sampled_from(["A", "B", "C", "a", ""])
_values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.text(string.printable, max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(_names, inner, max_size=3),
    max_leaves=4,
)


@st.composite
def _messages(draw):
    pairs = draw(st.lists(st.tuples(_names, _values), max_size=4))
    text = "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in pairs) + "}"
    cut = draw(st.integers(0, 3 * len(text)))
    return text[:cut] + draw(st.sampled_from(["", "", "", "}", " x"]))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(_messages(), min_size=60, max_size=120))
def test_same_outcomes_as_the_plain_check(spark, texts):
    topic = _topic(spark, texts)
    got = {r.id: r.outcome for r in validate(topic, AB, keep=["id"]).collect()}
    want = {r.id: r.outcome for r in _plain(topic).collect()}
    assert got == want
    table = checked_table(topic, AB)
    count = Counter(r.outcome for r in table.collect())
    assert count == Counter(want.values())
    assert table.exceptAll(checked_table(topic, AB, unfiltered=True)).count() == 0


def test_values_with_json_signs(spark):
    texts = [
        '{"A":"10:30","B":"http://x"}',
        '{"A":{"q":1},"B":"x"}',
        '{"A":"1","B":"x"} : : :',
        '{"A":"1:2","B":"x","C":"z"}',
        '{"A":"1","A":"2","B":"x","B":"y"}',
        '{"A":"1","C":"2"}',
    ]
    outcomes = [r.outcome for r in checked_table(_topic(spark, texts), AB).collect()]
    assert outcomes == [OK, OK, OK, EXTRA, OK, MISSING]
    assert conforming_rows(_topic(spark, texts), AB, outcomes=[OK]).count() == 4


def test_each_message_is_parsed_once(spark):
    wide = CONTRACTS["DimAffilie"]
    topic = _topic(spark, ["{}"])
    for frame in (
        checked_table(topic, wide),
        checked_table(topic, wide).where("outcome <> 'ok'"),
        checked_table(topic, wide, unfiltered=True),
        conforming_rows(topic, wide),
        conforming_rows(topic, wide, outcomes=[OK]),
        message_errors(topic, wide),
        message_errors(topic, wide, outcomes=[MISSING]),
        missing_flags(topic, wide),
    ):
        assert optimized(frame).count("from_json") == 1
        assert "Exchange" not in physical(frame)


def test_keys_are_read_only_where_they_matter(spark):
    topic = _topic(spark, ["{}"])
    assert "jsonObjectKeys" not in optimized(conforming_rows(topic, AB))
    assert "jsonObjectKeys" in optimized(conforming_rows(topic, AB, outcomes=[OK]))
