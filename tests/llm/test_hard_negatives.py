from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.llm import hard_negatives
from tamis.llm.hard_negatives import Anchors, Negatives, Positives, Rule
from tests.llm.frames import CLASHING

SCHEMA = "vec_id long, embedding array<float>, label int"


def _mine(frame):
    return hard_negatives.mine(frame, F.col("vec_id") % 10 == 0)


def _frame(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in rows]
    return spark.createDataFrame(rows, SCHEMA)


def _brute(rows, rule=Rule(), every=10):
    whole = [(i, [int(np.floor(rule.scale * float(np.float32(x)))) for x in v], label) for i, v, label in rows]
    out = set()
    for a, u, label in whole:
        if a % every:
            continue
        scores = {(i, sum(x * y for x, y in zip(u, v)), own == label) for i, v, own in whole if i != a and len(v) == len(u)}
        ranked = sorted(scores, key=lambda r: (-r[1], r[0]))
        for p, ps, _ in [r for r in ranked if r[2]][: rule.positives]:
            fit = [r for r in ranked if not r[2] and rule.low * ps <= 100 * r[1] <= rule.high * ps]
            out |= {(a, p, n + 1, i, ps, s) for n, (i, s, _) in enumerate(fit[: rule.negatives])}
    return out


def _vectors(count=600, size=16):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, size))
    own = centres[rng.integers(12, size=count)] + rng.normal(size=(count, size)) * 0.3
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    own *= rng.choice([0.2, 1, 3], size=(count, 1))
    own[7::40] = own[3]  # ties
    return [(i, v.astype(np.float32), int(rng.integers(4))) for i, v in enumerate(own)]


@pytest.mark.parametrize("values", [hard_negatives.VALUES, 300])
def test_equals_brute_force(spark, monkeypatch, values):
    monkeypatch.setattr(hard_negatives, "VALUES", values)  # the second: several blocks
    rows = _vectors()
    got = _mine(_frame(spark, rows).repartition(3))
    assert got.columns == [f.split()[0] for f in hard_negatives.RESULT.split(", ")]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == _brute(rows)
    assert len(found) > 300


def test_walks_end_before_the_list_does():
    rows = _vectors(4000)
    ids = np.array([i for i, _, _ in rows])
    labels = np.array([label for _, _, label in rows])
    vectors = np.floor(256 * np.stack([v for _, v, _ in rows]).astype(np.float64))
    some = ids % 10 == 0
    anchors = Anchors(ids[some], labels[some], vectors[some])
    walk = Positives(anchors, 5)
    walk.rows(ids, labels, vectors)
    assert walk.scored < 0.7 * walk.pairs
    below = Negatives(anchors, [found[1].tolist() for found in walk.found], Rule())
    below.rows(ids, labels, vectors)
    assert below.scored < 0.9 * below.pairs


def test_bound_is_certified():
    rng = np.random.default_rng(1)
    vectors = np.floor(256 * rng.normal(size=(500, 8)))
    anchors = Anchors(np.arange(100), np.zeros(100), vectors[:100])
    norms = hard_negatives._norms(vectors)
    angles = hard_negatives._angles(hard_negatives._units(vectors, norms), anchors.centroids)
    assert sorted(np.concatenate(anchors.members).tolist()) == list(range(100))
    for c, members in enumerate(anchors.members):
        bound = norms * np.cos(np.maximum(0, angles[:, c] - anchors.spread[c]))
        scores = vectors[members] @ vectors.T
        assert (scores <= anchors.norms[members, None] * (bound[None] + hard_negatives.SLACK * norms.max())).all()


def test_edge_cases(spark):
    assert _mine(_frame(spark, [])).collect() == []
    nan, inf = float("nan"), float("inf")
    good = [
        (0, [1, 0], 1),
        (1, [1, 0], 1),
        (2, [1, 0], 1),
        (3, [0.8, 0], 2),
        (4, [0.8, 0], 3),
        (5, [0.95, 0], 2),  # at the upper end of the window
        (6, [0.5, 9], 2),  # at the lower end
        (8, [0.4, 0], 2),
        (9, [-1, 0], 1),  # its window is empty
        (10, [0, 0], 1),  # a zero anchor: all scores are 0
        (11, [1, 0, 0], 1),  # other length
        (20, [1, 1, 1], 5),  # no positive
        (30, [], 2),
        (31, [], 2),
        (32, [], 3),
    ]
    bad = [(40, [1, 0], None), (50, None, 1), (60, [nan, 1], 1), (70, [1, inf], 2), (80, [1, None], 1), (None, [1, 0], 1)]
    frame = _frame(spark, good + bad)
    want = _brute(good)
    assert (0, 1, 1, 5, 65536, 62208) in want and {r[0] for r in want} == {0, 10, 30}
    assert {tuple(r) for r in _mine(frame).collect()} == want
    twice = _mine(frame.unionByName(frame))  # repeated rows count once
    assert sorted(map(tuple, twice.collect())) == sorted(want)
    more = frame.selectExpr("*", "3 AS score", "4 AS anchor", "5 AS place", "'s' AS is_anchor", "6 AS id", *CLASHING)
    assert {tuple(r) for r in _mine(more).collect()} == want


def test_large_components_are_exact_or_refused(spark):
    rows = [(0, [3e5, 1], 1), (1, [3e5, 3], 1), (2, [2e5, 5], 2), (3, [2e5, 1], 2)]
    assert {tuple(r) for r in _mine(_frame(spark, rows)).collect()} == _brute(rows)
    rows = [(0, [3e30, 1], 1), (1, [3e30, 3], 1)]
    with pytest.raises(Exception, match="64"):
        _mine(_frame(spark, rows)).collect()
