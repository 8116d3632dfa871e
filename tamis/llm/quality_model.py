"""A factorisation machine that scores the quality of texts.

Features are hashed words and statistics of structure, all from the text alone.  The score is
``sigmoid(w0 + <w, x> + sum over pairs <v_i, v_j> x_i x_j)``; the pairs take linear time, as half
of the square of the sums less the sum of the squares.  The model is fitted on the driver to a
bounded sample of labelled rows (``SAMPLE``, those with the smallest hash of their id) and sent
to the tasks; its size is fixed by ``DIMS`` and ``FACTORS``.  Every document is scored whole.

Defined cases: a null or empty text has no words and gets the score of its statistics; unlabelled
rows and those with a null label are scored but not learned from; of several labels of one id,
the smallest counts; repeated rows are scored each and learned from once; with no labelled row, or labels of one kind
only, all scores are the share of good labels (a half without any); an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that are learned from, hashed words, and factors of each feature.
SAMPLE, DIMS, FACTORS = 12_000, 4096, 8
HELD_OUT = 2
GOOD = 0.7
CACHE = 500_000

SYMBOLS = b"#*$%&|<>"
MARKS = b"!?~^=_/\\{}[]@"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
N_STATS = 14
#: How features of the sample are sent to the driver: 6 bytes for each different word of a row.
_KINDS = (np.uint16, np.float32, np.float64)


class Features:
    """Sparse rows: bins of words with their weights, and a dense row of statistics."""

    def __init__(self) -> None:
        self._bin: dict[bytes, int] = {}

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = text.split()
        known = self._bin
        try:
            found = list(map(known.__getitem__, words))
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for word in set(words).difference(known):
                known[word] = zlib.crc32(word.lower()) % DIMS
            found = list(map(known.__getitem__, words))
        counts = np.bincount(np.array(found, dtype=np.int64), minlength=1)
        bins = np.flatnonzero(counts)
        weights = np.log1p(counts[bins])
        norm = np.sqrt((weights**2).sum()) or 1.0
        return bins, weights / norm, self._stats(text, words)

    @staticmethod
    def _stats(text: bytes, words: list[bytes]) -> np.ndarray:
        n, distinct = len(words), len(set(words))
        solid = sum(map(len, words)) or 1
        share = lambda kind: (len(text) - len(text.translate(None, kind))) / solid
        lines = [line for line in text.split(b"\n") if line.strip()]
        windows = len(set(zip(words, words[1:], words[2:])))
        stats = (
            np.log1p(n) / 8,
            np.log1p(n) ** 2 / 64,
            distinct / max(n, 1),
            windows / max(n - 2, 1),
            solid / max(n, 1) / 10,
            share(SYMBOLS),
            share(MARKS),
            share(UPPER),
            share(DIGITS),
            share(b".,;:"),
            share(b"|"),
            len(set(lines)) / max(len(lines), 1),
            len(lines) / max(n, 1),
            1.0 if n < 50 else 0.0,
        )
        return np.clip(np.array(stats), 0, 3)


@dataclass
class Machine:
    """Weights of the bins come first, then those of the statistics."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def x(self, bins: np.ndarray, weights: np.ndarray, stats: np.ndarray):
        index = np.concatenate([bins.astype(np.int64), np.arange(DIMS, DIMS + N_STATS)])
        return index, np.concatenate([weights, (stats - self.centre) / self.scale])

    def raw(self, index: np.ndarray, x: np.ndarray) -> float:
        xv = x[:, None] * self.v[index]
        pairs = 0.5 * ((xv.sum(0) ** 2).sum() - (xv**2).sum())
        return float(self.w0 + x @ self.w[index] + pairs)

    def score(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(*self.x(*features)), -30, 30))))


def fit(rows: list[tuple], labels: np.ndarray, epochs: int = 6, seed: int = 7) -> Machine:
    """Adagrad over single rows of features; then the scores' slope and level are set by Platt's method on
    the tenth of the rows that was not learned from."""
    rng = np.random.default_rng(seed)
    total = DIMS + N_STATS
    share = float(labels.mean()) if len(labels) else 0.5
    machine = Machine(
        float(np.log((share + 1e-3) / (1 - share + 1e-3))),
        np.zeros(total),
        rng.normal(0, 0.01, (total, FACTORS)),
        np.zeros(N_STATS),
        np.ones(N_STATS),
    )
    if len(set(labels.tolist())) < 2:
        machine.v[:] = 0
        return machine
    stats = np.stack([row[2] for row in rows])
    machine.centre, machine.scale = stats.mean(0), stats.std(0) + 0.05
    rows = [_narrow(*machine.x(*row)) for row in rows]
    order = rng.permutation(len(rows))
    judge, learn = order[: len(rows) // 10], order[len(rows) // 10 :]
    weight = {1: 0.5 / share, 0: 0.5 / (1 - share)}
    g0, gw, gv = 1e-6, np.full(total, 1e-6), np.full((total, FACTORS), 1e-6)
    for _ in range(epochs):
        for n in rng.permutation(learn):
            index, x = rows[n]
            v = machine.v[index]
            xv = x[:, None] * v
            s = xv.sum(0)
            raw = machine.w0 + x @ machine.w[index] + 0.5 * ((s**2).sum() - (xv**2).sum())
            p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            error = (p - labels[n]) * weight[int(labels[n])]
            d0, dw = error, error * x + 1e-5 * machine.w[index]
            dv = error * (x[:, None] * (s - xv)) + 1e-4 * v
            g0 += d0**2
            gw[index] += dw**2
            gv[index] += dv**2
            machine.w0 -= 0.1 * d0 / np.sqrt(g0)
            machine.w[index] -= 0.1 * dw / np.sqrt(gw[index])
            machine.v[index] -= 0.02 * dv / np.sqrt(gv[index])
    return _calibrated(machine, [rows[n] for n in judge], labels[judge])


def _narrow(index: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return index.astype(np.uint16), x.astype(np.float32)


def _calibrated(machine: Machine, rows: list, labels: np.ndarray) -> Machine:
    raw = np.array([machine.raw(*row) for row in rows])
    good, bad = labels.sum(), len(labels) - labels.sum()
    aim = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's method, held back
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        g = np.array([((p - aim) * raw).sum(), (p - aim).sum()])
        q = p * (1 - p) + 1e-6
        h = np.array([[(q * raw**2).sum(), (q * raw).sum()], [(q * raw).sum(), q.sum()]])
        step = np.linalg.solve(h + 1e-3 * np.eye(2), g)
        a, b = float(np.clip(a - step[0], 0.05, 5)), float(np.clip(b - step[1], -5, 5))
    # a scales the raw score: linear weights by a, factors by its root
    return Machine(a * machine.w0 + b, a * machine.w, np.sqrt(a) * machine.v, machine.centre, machine.scale)


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == HELD_OUT


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """The machine fitted to at most ``sample`` labelled rows that are not held out, one for each
    id: of several the one whose text has the smallest hash."""
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.of(t.as_py()) for t in batch.column(2)]
            columns = [
                pa.array([row[n].astype(kind).tobytes() for row in found], pa.binary())
                for n, kind in enumerate(_KINDS)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), *columns],
                ["doc_id", "quality", "hash", "bins", "weights", "stats"],
            )

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    sampled = docs.select(F.col("doc_id").cast("long"), text).join(F.broadcast(marked), "doc_id")
    kind = "bins binary, weights binary, stats binary"
    rows = (
        sampled.select("doc_id", F.col("quality").cast("int"), "text", F.xxhash64("text"))
        .mapInArrow(featured, f"doc_id long, quality int, hash long, {kind}")
        .groupBy("doc_id")
        .agg(F.min(F.struct("hash", "quality", "bins", "weights", "stats")).alias("row"))
        .select("doc_id", "row.*")
        .orderBy("doc_id")
        .collect()
    )
    features = [
        tuple(np.frombuffer(r[c], dtype=k) for c, k in zip(("bins", "weights", "stats"), _KINDS))
        for r in rows
    ]
    return fit(features, np.array([r["quality"] for r in rows], dtype=float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``, ``predicted``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            # one text at a time: a batch may hold very long ones
            scores = [machine.score(features.of(t.as_py())) for t in batch.column(2)]
            good = pa.array([int(s >= GOOD) for s in scores], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), good],
                ["doc_id", "held_out", "score", "predicted"],
            )

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), text).mapInArrow(
        scored, "doc_id long, held_out boolean, score double, predicted int"
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn(docs.select("doc_id", "text"), labels.select("doc_id", "quality")))
