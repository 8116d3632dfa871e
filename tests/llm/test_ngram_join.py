from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from tamis.llm import ngram_join
from tamis.llm.components import components
from tamis.llm.ngram_join import Rule
from tests.llm.frames import CLASHING, DOCS, documents, text_of
from tests.llm.graphs import roots_of


def _set(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def _brute(texts, rule):
    sets = {i: _set(t, rule.words) for i, t in texts.items()}
    pairs = [
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= rule.percent * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, roots_of(sets, pairs)


def _texts(count=260):
    """Edited copies of a few originals of many lengths, with a passage that many share."""
    rng = random.Random(11)
    passage = text_of(99, 15)
    originals = [text_of(i, n) for i, n in enumerate((1, 2, 3, 4, 5, 8, 12, 20, 35, 60, 150, 400))]
    texts = {}
    for i in range(count):
        words = originals[i % len(originals)].split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = rng.choice(["new", "other", "X"])
        if i % 4 == 0:
            words = [*words[: len(words) // 2], *passage.split(), *words[len(words) // 2 :]]
        texts[i] = " ".join(words)
    return texts | {count + i: f"{passage} {text_of(1000 + i, 30)}" for i in range(40)}


@pytest.mark.parametrize(
    ("rule", "chunks"), [(Rule(4, 85), 16), (Rule(5, 80), 1), (Rule(2, 50), 16), (Rule(3, 95), 1)]
)
def test_components(spark, monkeypatch, rule, chunks):
    monkeypatch.setattr(ngram_join, "CROWD", 16)  # so that blocks and clusters are cut
    monkeypatch.setattr(ngram_join, "CHUNKS", chunks)  # and some clusters are huge
    texts = _texts()
    sizes, roots = _brute(texts, rule)
    got = ngram_join.groups(documents(spark, [(i, t, "en", "s") for i, t in texts.items()]), rule).collect()
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert {r.doc_id: r.component_id for r in got} == roots
    assert len(set(roots.values())) < len(texts) - 50


@pytest.mark.parametrize("rule", [Rule(4, 85), Rule(5, 80), Rule(2, 60)])
def test_linked_sets_share_a_key_and_close_marks(rule):
    rng = np.random.default_rng(5)
    sketches = ngram_join.Sketches(rule)
    pool = lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)
    linked = 0
    for _ in range(1500):
        n = int(rng.integers(1, 300))
        a = np.unique(pool(n))
        drop = int(rng.integers(0, n // 4 + 1))
        add = int(rng.integers(0, n // 4 + 1))
        b = np.unique(np.concatenate([a[drop:], pool(add)]))
        common = len(np.intersect1d(a, b))
        if len(b) and rule.linked(common, len(a), len(b)) and (drop or add):
            linked += 1
            (ka, ma), (kb, mb) = sketches.of(a), sketches.of(b)
            assert np.intersect1d(ka, kb).size
            assert ngram_join._close(rule, len(a), len(b), ma, mb)
            assert len(a) + len(b) - 2 * common <= rule.apart(len(a), len(b))
    assert linked > 200


@pytest.mark.parametrize("held", [500_000, 25])
def test_components_of_chains_and_hubs(spark, monkeypatch, held):
    monkeypatch.setattr("tamis.llm.components.HELD", held)
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199)]
    rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    assert {r.node: r.root for r in rows} == roots_of(nodes, pairs)
    assert len(rows) == len(nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_group_stays(spark):
    texts = _texts(120)
    rows = [(i, t, "en", "s") for i, t in texts.items()]
    _, roots = _brute(texts, Rule())
    kept = ngram_join.distinct_documents(documents(spark, rows + rows[:30]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))


def test_rows_with_one_id_are_documents_of_their_groups(spark):
    a, b, c = (text_of(seed, 60) for seed in (21, 22, 23))
    near = lambda text: text + " more"
    rows = [
        (5, a),  # led by 5, as the next is in another group
        (5, b),
        (6, near(b)),
        (3, c),
        (5, near(c)),  # led by 3
        (8, ""),  # empty sets link with nothing
        (8, "one line"),
        (8, "one line"),
    ]
    kept = ngram_join.distinct_documents(documents(spark, [(i, t, "en", "s") for i, t in rows]))
    want = [(3, c), (5, a), (5, b), (8, ""), (8, "one line")]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(want)


def test_edge_cases(spark):
    empty = documents(spark, [])
    assert ngram_join.groups(empty).count() == 0
    assert ngram_join.distinct_documents(empty).count() == 0
    rows = documents(spark, DOCS)
    got = defaultdict(set)
    for r in ngram_join.groups(rows).collect():
        got[r.doc_id].add((r.n_shingles, r.component_id))
    assert got[1] == {(0, 1)} and got[2] == {(0, 2)} and got[7] == {(0, 7)}
    assert got[4] == {(1, 3)} and got[6] == {(2996, 5)}
    assert got[None] == {(1, 3), (0, None)}  # the line without id, and the row of nulls
    more = rows.selectExpr("*", *CLASHING, "1 AS n_shingles", "'k' AS keys", "2 AS component_id")
    assert ngram_join.groups(more).count() == len(DOCS)
    kept = ngram_join.distinct_documents(more)
    assert kept.columns == more.columns
    # the line without id is a copy of document 3, the row of nulls of none
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 3, 5, 7, 8, None]


def test_rows_without_id_link_and_go_as_others_do(spark):
    a, far = text_of(31, 90), text_of(32, 90)
    b = a + " end"
    rows = [(1, a), (None, b), (None, b), (None, far), (None, far), (None, far + " x"), (None, ""), (None, None), (None, " ")]
    frame = documents(spark, [(i, t, "en", "s") for i, t in rows])
    got = {(r.n_shingles, r.component_id) for r in ngram_join.groups(frame).collect()}
    assert got == {(86, 1), (87, 1), (86, None), (87, None), (0, None)}
    kept = [(r.doc_id, r.text) for r in ngram_join.distinct_documents(frame).collect()]
    assert kept.count((1, a)) == 1 and (None, b) not in kept
    assert sum(t is not None and t.startswith(far) for _, t in kept) == 1
    assert len(kept) == 5  # those without words all stay
