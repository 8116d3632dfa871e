"""Hard negatives by lists that a cluster of anchors shares (after MAXIMUS).

Anchors are clustered by direction.  For a cluster with centroid ``c``, whose members lie within
the angle ``b`` of it, a row ``x`` at the angle ``t`` from ``c`` scores at most
``|u| * |x| * cos(max(0, t - b))`` with a member ``u``.  The rows that a task holds are sorted by
this bound once for each cluster, and every member walks that one list until the bound certifies
that nothing behind can enter its result.  Scores are integer inner products and are exact.

Two walks are needed.  The first finds an anchor's positives, its best rows of the same label.  The
second finds for each positive the best rows of other labels whose score lies in a window below
the positive's.  Each task walks with all it has read so far and hands on the few rows it found;
these are merged by window functions.

Anchors are a share of all rows, so they are dealt to blocks of at most about ``VALUES``
components.  A block is clustered, broadcast, and walked against all rows, in two scans without a
shuffle of vectors; memory depends on neither the rows nor the number of blocks.

Defined cases: rows without id or label, with a null vector or with null or non-finite components
take no part; vectors of different lengths have no score; rows with an anchor's id are no partners
of that anchor; rows of one id and equal score count once; anchors of one id and different vectors
are anchors of their own; a positive with a negative score has no negatives (its window is empty);
an empty table gives an empty result; extra columns are ignored.  An inner product that does not
fit 64 bits is refused by an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import settle

#: Components of the anchors that are walked in one scan.
VALUES = 4_000_000
#: Anchors of a cluster on average, clusters of a block, and rounds of clustering.
MEMBERS, CLUSTERS, ROUNDS = 32, 256, 4
#: Components of the rows that are sorted together, and rows of a step along the list.
CHUNK, STEP = 1_000_000, 256
#: Doubles hold integers exactly below this.
EXACT = 2.0**53
LONG = 2**63 - 1
#: How far rounding may take a bound, relative to the product of norms.
SLACK = 1e-6

RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long,"
    " negative_score long"
)


@dataclass(frozen=True)
class Rule:
    """``positives`` rows of the anchor's label; for each, ``negatives`` rows of other labels with
    ``low * positive <= 100 * score <= high * positive``.  Components are cut to integers after
    they are multiplied by ``scale``."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256


def usable() -> Column:
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    return F.coalesce(known & good, F.lit(False))


def _integers(column: pa.Array, scale: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(len(column), -1)


def _norms(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt((vectors**2).sum(axis=1))
    if not np.isfinite(norms).all():
        raise ValueError("components are too large for 64-bit scores")
    return norms


def _units(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return vectors / np.where(norms > 0, norms, 1)[:, None]


def _angles(units: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centroids.T, -1, 1))


class Anchors:
    """The anchors of one block and length, and their clusters by direction."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.norms = _norms(vectors)
        units = _units(vectors, self.norms)
        rng = np.random.default_rng(len(ids))
        k = max(1, min(CLUSTERS, len(ids) // MEMBERS))
        self.centroids = units[rng.choice(len(ids), k, replace=False)]
        for _ in range(ROUNDS):
            own = (units @ self.centroids.T).argmax(axis=1)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, own, units)
            lengths = np.sqrt((sums**2).sum(axis=1))
            moved = lengths > 0
            self.centroids[moved] = sums[moved] / lengths[moved, None]
        angles = _angles(units, self.centroids)
        own = angles.argmin(axis=1)
        self.members = [np.flatnonzero(own == c) for c in range(k)]
        # a zero vector has no direction, and its scores are 0 whatever the bound
        turned = self.norms > 0
        self.spread = [angles[m[turned[m]], c].max(initial=0.0) for c, m in enumerate(self.members)]

    def products(self, which: np.ndarray, rows: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Exact integer scores of some anchors (down) with some rows (across)."""
        own = self.vectors[which]
        if self.norms[which].max(initial=0) * norms.max(initial=0) < EXACT:
            return (own @ rows.T).astype(np.int64)
        whole = np.vectorize(int, otypes=[object])
        found = whole(own).dot(whole(rows).T) if own.shape[1] else np.zeros((len(own), len(rows)), dtype=object)
        if (abs(found) > LONG).any():
            raise ValueError("an inner product does not fit 64 bits")
        return found.astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``most`` different (id, score) by falling score and rising id."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    if len(ids) > 1:
        fresh = np.concatenate([[True], (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])])
        ids, scores = ids[fresh], scores[fresh]
    return ids[:most], scores[:most]


class Walk:
    """Walks of all anchors along the shared lists of one chunk of rows after the other.

    A subclass says which scores it wants and keeps ``least``, the score below which nothing can
    enter an anchor's result any more.
    """

    def __init__(self, anchors: Anchors):
        self.anchors = anchors
        self.least = np.full(len(anchors.ids), -np.inf)
        #: Scores that walks have computed, of all pairs of an anchor and a row.
        self.scored = self.pairs = 0

    def _keep(self, anchor: int, scores: np.ndarray, ids: np.ndarray, same: np.ndarray) -> None:
        raise NotImplementedError

    def rows(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        anchors = self.anchors
        norms = _norms(vectors)
        angles = _angles(_units(vectors, norms), anchors.centroids)
        slack = SLACK * anchors.norms * norms.max(initial=0) + SLACK
        self.pairs += len(ids) * len(anchors.ids)
        for c, members in enumerate(anchors.members):
            bound = norms * np.cos(np.maximum(0, angles[:, c] - anchors.spread[c]))
            order = np.argsort(-bound, kind="stable")
            active = members
            for start in range(0, len(order), STEP):
                limit = anchors.norms[active] * bound[order[start]] + slack[active]
                active = active[limit >= self.least[active]]
                if not len(active):
                    break
                step = order[start : start + STEP]
                self.scored += len(active) * len(step)
                scores = anchors.products(active, vectors[step], norms[step])
                same = anchors.labels[active, None] == labels[None, step]
                other = anchors.ids[active, None] != ids[None, step]
                hopeful = other & (scores >= self.least[active, None])
                for n in np.flatnonzero(hopeful.any(axis=1)).tolist():
                    at = hopeful[n]
                    self._keep(int(active[n]), scores[n, at], ids[step[at]], same[n, at])


class Positives(Walk):
    def __init__(self, anchors: Anchors, most: int):
        super().__init__(anchors)
        self.most = most
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(anchors.ids)

    def _keep(self, anchor: int, scores: np.ndarray, ids: np.ndarray, same: np.ndarray) -> None:
        own = self.found[anchor]
        best = _best(np.concatenate([own[0], ids[same]]), np.concatenate([own[1], scores[same]]), self.most)
        self.found[anchor] = best
        if len(best[1]) == self.most:
            self.least[anchor] = best[1][-1]

    def table(self) -> list[tuple[int, int, int, int]]:
        """Anchor, 0, id and score of what was found."""
        return [(n, 0, int(i), int(s)) for n, found in enumerate(self.found) for i, s in zip(*found)]


class Negatives(Walk):
    """Walks below the positives: ``scores`` holds a row of positive scores for each anchor."""

    def __init__(self, anchors: Anchors, scores: list[list[int]], rule: Rule):
        super().__init__(anchors)
        self.rule = rule
        self.windows = [
            [(-(-rule.low * s // 100), rule.high * s // 100) for s in own] for own in scores
        ]
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.found = [[none] * len(own) for own in self.windows]
        for anchor in range(len(self.windows)):
            self._settle(anchor)

    def _settle(self, anchor: int) -> None:
        """Walks go on for the window that still takes the lowest score."""
        least = np.inf
        for (low, high), (_, scores) in zip(self.windows[anchor], self.found[anchor]):
            if low <= high:
                least = min(least, scores[-1] if len(scores) == self.rule.negatives else low)
        self.least[anchor] = least

    def _keep(self, anchor: int, scores: np.ndarray, ids: np.ndarray, same: np.ndarray) -> None:
        ids, scores = ids[~same], scores[~same]
        for n, (low, high) in enumerate(self.windows[anchor]):
            inside = (scores >= low) & (scores <= high)
            if inside.any():
                own = self.found[anchor][n]
                self.found[anchor][n] = _best(
                    np.concatenate([own[0], ids[inside]]),
                    np.concatenate([own[1], scores[inside]]),
                    self.rule.negatives,
                )
        self._settle(anchor)

    def table(self) -> list[tuple[int, int, int, int]]:
        """Anchor, place of the positive, id and score of what was found."""
        return [
            (n, place, int(i), int(s))
            for n, slots in enumerate(self.found)
            for place, found in enumerate(slots)
            for i, s in zip(*found)
        ]


_FOUND = "size int, anchor int, place int, id long, score long"


def _walked(rows: DataFrame, shared, rule: Rule) -> DataFrame:
    """What each task's walks have found, by length of the vectors.

    ``shared`` has, for each length, anchors and None, or the scores of their positives.
    """

    def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {
            size: Positives(anchors, rule.positives) if scores is None else Negatives(anchors, scores, rule)
            for size, (anchors, scores) in shared.value.items()
        }
        held: dict[int, list] = {size: [] for size in own}

        def walk(size: int) -> None:
            if held[size]:
                own[size].rows(*(np.concatenate(side) for side in zip(*held[size])))
                held[size] = []

        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy()
            for size in np.unique(lengths).tolist():
                if size not in own:
                    continue
                some = batch.filter(pa.array(lengths == size))
                most = max(1, CHUNK // max(size, 1))
                for at in range(0, some.num_rows, most):
                    part = some.slice(at, most)
                    vectors = _integers(part.column(2), rule.scale)
                    held[size].append((part.column(0).to_numpy(), part.column(1).to_numpy(), vectors))
                    if sum(len(x[0]) for x in held[size]) >= most:
                        walk(size)
        for size in own:
            walk(size)
            found = own[size].table()
            for at in range(0, len(found), 100_000):
                columns = [list(c) for c in zip(*found[at : at + 100_000])]
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([size] * len(columns[0]), pa.int32()),
                        *(pa.array(c, kind) for c, kind in zip(columns, kinds)),
                    ],
                    ["size", "anchor", "place", "id", "score"],
                )

    return rows.mapInArrow(walks, _FOUND)


def _merged(found: DataFrame, most: int) -> DataFrame:
    """The best of all tasks, with their ``rank``."""
    order = Window.partitionBy("size", "anchor", "place").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _block(rows: DataFrame, anchors: DataFrame, rule: Rule) -> DataFrame:
    """The result for one block of anchors."""
    context = rows.sparkSession.sparkContext
    held = anchors.toArrow().combine_chunks()
    lengths = pa.compute.list_value_length(held.column("embedding")).to_numpy()
    own: dict[int, Anchors] = {}
    for size in np.unique(lengths).tolist():
        some = held.filter(pa.array(lengths == size)).combine_chunks()
        vectors = _integers(some.column("embedding").chunk(0), rule.scale)
        own[size] = Anchors(some.column("vec_id").to_numpy(), some.column("label").to_numpy(), vectors)
    shared = context.broadcast({size: (a, None) for size, a in own.items()})
    positives = _merged(_walked(rows, shared, rule), rule.positives).collect()
    of: dict[int, list[list[tuple[int, int]]]] = {size: [[] for _ in a.ids] for size, a in own.items()}
    for row in sorted(positives, key=lambda r: r["rank"]):
        of[row["size"]][row["anchor"]].append((row["id"], row["score"]))
    scores = {size: [[s for _, s in found] for found in own_of] for size, own_of in of.items()}
    shared = context.broadcast({size: (a, scores[size]) for size, a in own.items()})
    negatives = _merged(_walked(rows, shared, rule), rule.negatives)
    named = [
        (size, n, place, int(anchor), *positive)
        for size, a in own.items()
        for n, anchor in enumerate(a.ids)
        for place, positive in enumerate(of[size][n])
    ]
    schema = "size int, anchor int, place int, anchor_id long, positive_id long, positive_score long"
    names = rows.sparkSession.createDataFrame(named, schema)
    # a row for each positive of the block's anchors
    return negatives.join(F.broadcast(names), ["size", "anchor", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def mine(vectors: DataFrame, is_anchor: Column, rule: Rule = Rule()) -> DataFrame:
    """One row per anchor, positive and negative, see ``RESULT``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on them.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding", is_anchor.alias("is_anchor")
    ).filter(usable())
    anchors = rows.filter("is_anchor").drop("is_anchor").distinct()
    rows = rows.drop("is_anchor")
    values = anchors.agg(F.sum(F.size("embedding") + 1)).first()[0]
    if values is None:
        return rows.sparkSession.createDataFrame([], RESULT)
    blocks = 1 + values // VALUES
    place = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(blocks))
    found = None
    for n in range(blocks):
        part = _block(rows, anchors.filter(place == n), rule) if blocks > 1 else _block(rows, anchors, rule)
        part = settle(part, "negatives") if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    return found
