from __future__ import annotations

import zlib

import numpy as np
import pytest

from tamis.llm import quality_model as q
from tests.llm.frames import CLASHING, DOCS, documents, text_of

LABELS = "doc_id long, quality int, toxic int"


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    total = q.DIMS + q.N_STATS
    machine = q.Machine(
        0.3, rng.normal(size=total), rng.normal(size=(total, q.FACTORS)), np.zeros(q.N_STATS), np.ones(q.N_STATS)
    )
    index, x = machine.x(*q.Features().of(b"some words and some more\nWORDS!! 12"))
    pairs = sum(
        machine.v[index[i]] @ machine.v[index[j]] * x[i] * x[j]
        for i in range(len(x))
        for j in range(i + 1, len(x))
    )
    assert np.isclose(machine.raw(index, x), 0.3 + x @ machine.w[index] + pairs)


def _corpus(spark, count=240):
    """Good texts are varied, bad ones shout or repeat."""
    rows, labels = [], []
    for i in range(count):
        good = i % 3 > 0
        text = text_of(i, 40 + i % 50)
        if not good:
            text = text.upper().replace(" ", "!! ") if i % 2 else " ".join(text.split()[:2] * 30)
        rows.append((i, text, "en", "s"))
        labels.append((i, int(good), 0))
    return documents(spark, rows), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark):
    docs, labels = _corpus(spark)
    want = {r.doc_id: r.quality for r in labels.collect()}
    rows = q.classify(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 30
    assert sum(r.predicted == want[r.doc_id] for r in held) / len(held) >= 0.95


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = _corpus(spark, 90)
    flipped = labels.selectExpr(
        "doc_id", "IF(crc32(string(doc_id)) % 4 = 2, 1 - quality, quality) AS quality", "toxic"
    )
    scores = [sorted((r.doc_id, r.score) for r in q.classify(docs, x).collect()) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_the_sample_is_bounded(spark):
    docs, labels = _corpus(spark, 90)
    machine = q.learn(docs, labels, sample=20)
    assert machine.v.shape == (q.DIMS + q.N_STATS, q.FACTORS)


@pytest.mark.parametrize("quality", [[], [(1, 1, 0)], [(i, None, 0) for i in range(9)], [(None, 1, 0)]])
def test_few_labels(spark, quality):
    rows = documents(spark, DOCS)
    scores = {r.score for r in q.classify(rows, spark.createDataFrame(quality, LABELS)).collect()}
    assert len(scores) == 1


def test_one_row_is_learned_from_for_each_id(spark, monkeypatch):
    docs, labels = _corpus(spark)
    learned = []
    fit = q.fit
    monkeypatch.setattr(q, "fit", lambda features, labels: learned.append(labels) or fit(features, labels))
    one = next(r.doc_id for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != q.HELD_OUT)
    again = documents(spark, [(i, f"text {n}", "en", "s") for i in range(240) for n in range(5) if i == one])
    q.learn(docs, labels)
    q.learn(docs.unionByName(again), labels)
    assert len(learned[0]) == len(learned[1])


def test_edge_cases(spark):
    _, labels = _corpus(spark, 30)
    labels = labels.unionByName(labels)  # repeated labels
    assert q.classify(documents(spark, []), labels).count() == 0
    rows = documents(spark, DOCS)
    assert q.classify(rows, labels).count() == len(DOCS)
    more = rows.selectExpr("*", *CLASHING, "1 AS quality", "0.5 AS score")
    assert q.classify(more, labels.selectExpr("*", "'x' AS text")).count() == len(DOCS)
