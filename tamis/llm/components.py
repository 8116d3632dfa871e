"""Connected components of a graph that is only known as rows of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import settle


#: Links that a task holds at once; so few are put together in one task.
HELD = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of each node with the smallest one it reaches by the given links."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    p, q = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))  # nodes are sorted, so places are ordered as they are
    while True:
        low = np.minimum(root[p], root[q])
        before = root.copy()
        for side in (p, q):
            np.minimum.at(root, root[side], low)
            np.minimum.at(root, side, low)
        while (root[root] != root).any():
            root = root[root]
        if (before == root).all():
            break
    some = root != np.arange(len(nodes))
    return nodes[some], nodes[root[some]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as a forest; holds ``HELD`` links and what they came to."""
    none = np.zeros(0, dtype=np.int64)
    held, size = [(none, none)], 0
    for batch in batches:
        held.append(tuple(batch.column(n).to_numpy() for n in (0, 1)))
        size += batch.num_rows
        if size > HELD:
            u, v = forest(*(np.concatenate(side) for side in zip(*held)))
            held, size = [(u, v)], len(u)
            if 2 * size > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
                held, size = [(none, none)], 0
    u, v = forest(*(np.concatenate(side) for side in zip(*held)))
    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


_LINK = "u long, v long"


def _forests(links: DataFrame) -> tuple[DataFrame, int]:
    """The (settled) links as forests, and of how many tasks."""
    tasks = 1 + links.count() // HELD
    return settle(links.coalesce(tasks).mapInArrow(_contracted, _LINK), "links"), tasks


def _mark(edges: DataFrame) -> tuple:
    """A number of rows and a hash that tell whether rows have changed."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, of all nodes in the (settled)
    ``links`` (a, b).

    Tasks of ``HELD`` links each turn them into a forest.  If there are several, large-star and
    small-star steps follow in turn: each node's larger neighbours, then its smaller ones, are
    linked with the smallest neighbour, until every link leads to a root.  Minima are aggregated
    before they are shuffled, and a hub's links are split by skew handling.  Each round is
    written to the shared folder.
    """
    own = links.filter("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    edges, tasks = _forests(own)
    mark = _mark(edges)
    while tasks > 1:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        joined = settle(small.unionByName(least.select("u", F.col("m").alias("v"))), "links")
        edges, tasks = _forests(joined)
        before, mark = mark, _mark(edges)
        if mark == before:
            edges = edges.distinct()  # several tasks may have the same link
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
