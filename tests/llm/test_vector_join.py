from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.llm import vector_join
from tests.llm.graphs import roots_of

SCHEMA = "vec_id long, embedding array<float>, label int"


def _frame(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in rows]
    return spark.createDataFrame(rows, SCHEMA)


def _vectors(count=700, size=24):
    """Random vectors, clusters around the threshold, and exact copies in three labels."""
    rng = np.random.default_rng(2)
    own = rng.normal(size=(count, size))
    for i in range(0, count, 2):
        near = own[(i // 14) * 14]
        own[i] = near + rng.normal(size=size) * rng.choice([0.02, 0.14, 0.2, 0.25]) * np.linalg.norm(near) / size**0.5
    own[5::50] = own[3]
    return [(i, v.astype(np.float32), i % 30 // 14) for i, v in enumerate(own)]


def _brute(rows):
    ids = [i for i, _, _ in rows]
    x = np.stack([v for _, v, _ in rows]).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([label for _, _, label in rows])
    near = (x @ x.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    pairs = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))]
    return dict(zip(ids, near.sum(axis=1).tolist())), roots_of(ids, pairs)


@pytest.mark.parametrize("cell", [vector_join.CELL, 20])
def test_links_and_components(spark, monkeypatch, cell):
    monkeypatch.setattr(vector_join, "CELL", cell)
    rows = _vectors()
    links, roots = _brute(rows)
    assert sum(links.values()) > 500
    got = vector_join.near_duplicates(_frame(spark, rows)).collect()
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == roots
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_pigeonhole_misses_no_pair():
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 7, 64):
        space = vector_join.Space(size, 0.98)
        a = rng.normal(size=(300, size)).astype(np.float32)
        b = (a + rng.normal(size=a.shape) * 0.2 * np.linalg.norm(a, axis=1, keepdims=True) / size**0.5).astype(np.float32)
        near = (vector_join.unit(a) * vector_join.unit(b)).sum(axis=1) >= 0.98
        x, y = space.rotated(a), space.rotated(b)
        starts = [start for start, _ in space.bounds]
        within = np.add.reduceat((x - y) ** 2, starts, axis=1) <= space.budgets
        assert within[near].any(axis=1).all()
        cells = [np.floor(v[:, starts] / space.widths) for v in (x, y)]
        assert (abs(cells[0] - cells[1])[within] <= 1).all()


def test_edge_cases(spark):
    empty = vector_join.near_duplicates(_frame(spark, []))
    assert empty.count() == 0
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1, 0], 1),
        (2, [2, 0], 1),  # same direction
        (3, [1, 0], None),
        (4, None, 1),
        (5, [0, 0], 1),
        (6, [nan, 1], 1),
        (7, [1, inf], 1),
        (8, [1, None], 1),
        (9, [], 1),
        (10, [1, 0, 0], 1),  # other length
        (11, [1, 0], 2),
        (12, [-1, 0], 1),
        (13, [1, 0], 1),
        (13, [1, 0], 1),  # repeated
        (None, [1, 0], 1),
        (14, [1e-30, 0], 1),
    ]
    got = vector_join.near_duplicates(_frame(spark, rows))
    linked = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got.collect()}
    assert got.count() == len(rows)
    assert {x for x in linked if x[1]} == {
        (1, 4, 1, True),
        (2, 4, 1, False),
        (13, 4, 1, False),
        (14, 4, 1, False),
    }
    assert (None, 0, None, False) in linked and (4, 0, 4, True) in linked
    more = _frame(spark, rows).selectExpr("*", "1 AS n", "2 AS rep", "'c' AS cell", "3 AS n_links", "4 AS h0")
    assert vector_join.near_duplicates(more).count() == len(rows)


def _random(spark, count):
    values = F.array(*(F.randn(n).cast("float") for n in range(16)))
    return spark.range(count, numPartitions=8).select(F.col("id").alias("vec_id"), F.lit(1).alias("label"), values.alias("embedding"))


@pytest.mark.parametrize("count", [5_000, 500_000])
def test_copies_of_a_vector_do_not_grow_with_its_label(spark, count):
    placed = vector_join._placed(vector_join._named(_random(spark, count)), 0.98)
    counts = placed.groupBy(*vector_join.PLACE).agg(F.count("*").alias("vectors"))
    rows = vector_join._chunked(placed, counts).agg(F.count("*"), F.max(F.length("steps"))).first()
    assert rows[0] == 2 * vector_join.BLOCKS * count
    assert rows[1] == 16 // vector_join.BLOCKS  # a byte for each dimension of the block


@pytest.mark.parametrize("chunk", [1 << 14, 30])
def test_a_dense_cluster_is_counted_whole(spark, monkeypatch, chunk):
    """Two thousand different vectors, nearly all of which link with each other."""
    monkeypatch.setattr(vector_join, "CHUNK", chunk * 10 if chunk > 30 else 300)
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    base /= np.linalg.norm(base)
    rows = [(i, (base + rng.normal(size=16) * 0.033).astype(np.float32), 3) for i in range(2000)]
    rows += [(5000 + i, rng.normal(size=16).astype(np.float32), 3) for i in range(200)]
    links, roots = _brute(rows)
    assert 0.2 < sum(links.values()) / 2000**2 < 0.999
    got = vector_join.near_duplicates(_frame(spark, rows)).collect()
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == roots
