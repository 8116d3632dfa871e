"""Embedding near-duplicates by a subspace pigeonhole join.

Vectors of one label link if their cosine is at least ``LEAST``, so unit vectors that link have a
squared distance of at most ``2 - 2 * LEAST``.  Unit vectors are rotated and split into
``BLOCKS`` blocks of dimensions.  In at least one block, the squared distance of a linked pair is
at most the block's share of that budget.

Each block is range-joined.  What is shuffled for that is a vector's name and one byte for each of
the block's dimensions; the budget is widened by what rounding may add.  Vectors go to cells as
wide as the block's radius along the block's first dimension and visit the cell below, so each
is sent twice for each block, however many there are.  Within a cell, windows along the second
dimension are compared.  A cell yields no pairs but a row for each vector that has a candidate:
the smallest vector it reaches by them.

The union of the candidates over all blocks falls into clusters, few of which hold vectors that don't
link.  Vectors in clusters are fetched once, and all pairs of a cluster are verified by their cosine
in double precision, tile by tile; clusters of more than ``CHUNK`` vectors are cut, and their pairs of
chunks go to tasks of their own, as do those of cells with more than ``CELL`` rows.

Equal vectors are one class, named by a hash; a task sends each class once.  Exact but for collisions
of 64-bit hashes.

Defined cases: vectors that are null, zero, hold null or non-finite components or have no label
or id link with nothing; vectors of different lengths don't link; repeated rows link with each
other; different vectors with one id have links of their own; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import settle, small
from tamis.llm.components import components, forest

LEAST = 0.98
BLOCKS = 4
#: Rows of one cell and vectors of one cluster that a task compares at once.
CELL, CHUNK = 1 << 19, 1 << 14
SLACK = 1 + 1e-9
#: A coordinate of 1 as a byte.
UNIT = 127
#: Sides of a tile.
ROWS, COLUMNS = 256, 4096
#: Vectors in clusters that may be broadcast by name, and classes that a task remembers.
NAMES, SEEN = 1_000_000, 1_000_000
#: Cosines so close to the least one are computed again, one by one.
CLOSE = 1e-12
#: Roles of a vector in a pair of chunks.
FIRST, SECOND, GUEST = 0, 1, 2


class Space:
    """The rotation, the blocks and their radii for vectors of one length."""

    def __init__(self, size: int, least: float):
        self.size = size
        n = max(1, min(BLOCKS, size // 2))
        self.bounds = [(int(p[0]), int(p[-1]) + 1) for p in np.array_split(np.arange(size), n)]
        budget = 2 - 2 * least
        self.budgets = np.array([budget * (b - a) / size for a, b in self.bounds]) * SLACK
        self.widths = np.sqrt(self.budgets) * SLACK
        # rounding moves each coordinate by half a step at most, a difference by one
        dimensions = np.array([b - a for a, b in self.bounds])
        self.steps = UNIT * self.widths + np.sqrt(dimensions)

    @cached_property
    def rotation(self) -> np.ndarray:
        rng = np.random.default_rng(self.size)
        return np.linalg.qr(rng.normal(size=(self.size, self.size)))[0]

    def rotated(self, vectors: np.ndarray) -> np.ndarray:
        return unit(vectors) @ self.rotation


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors as stored, 32-bit numbers."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    values = pa.concat_arrays([c.flatten() for c in chunks])
    return values.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _linkable() -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    known = F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    return F.coalesce(known & good, F.lit(False))


def _named(vectors: DataFrame) -> DataFrame:
    """The rows with ``name``, the hash of the vector's class; null if it can't link."""
    return vectors.select(
        "vec_id",
        "label",
        "embedding",
        F.when(_linkable(), F.xxhash64("label", "embedding")).alias("name"),
    )


def _placed(named: DataFrame, least: float) -> DataFrame:
    """Each class in its cell of each block, and as a guest in the cell below: one byte for each of
    the block's dimensions."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces: dict[int, Space] = {}
        seen: set[int] = set()
        for batch in batches:
            names = batch.column(1).to_pylist()
            fresh = {name: n for n, name in enumerate(names) if name not in seen}
            seen.update(fresh)
            if len(seen) > SEEN:
                seen.clear()
            batch = batch.take(pa.array(sorted(fresh.values()), pa.int64()))
            lengths = batch.column(2).value_lengths().to_numpy()
            for size in np.unique(lengths).tolist():
                own = batch.filter(pa.array(lengths == size))
                space = spaces.setdefault(size, Space(size, least))
                rotated = space.rotated(_matrix(own.column(2)))
                steps = np.rint(rotated * UNIT).astype(np.int8)
                for block, (a, b) in enumerate(space.bounds):
                    cell = np.floor(rotated[:, a] / space.widths[block]).astype(np.int64)
                    whole = np.ascontiguousarray(steps[:, a:b])
                    part = pa.Array.from_buffers(pa.binary(b - a), len(whole), [None, pa.py_buffer(whole)])
                    for role, at in ((FIRST, cell), (GUEST, cell - 1)):
                        fixed = [np.full(len(at), x, dtype=np.int64) for x in (size, block, role)]
                        yield pa.RecordBatch.from_arrays(
                            [own.column(0), own.column(1), part.cast(pa.binary()), *map(pa.array, fixed), pa.array(at)],
                            ["label", "name", "steps", "size", "block", "role", "cell"],
                        )

    kind = f"label {dict(named.dtypes)['label']}, name long, steps binary, size long, block long, role long, cell long"
    return named.filter("name is not null").select("label", "name", "embedding").mapInArrow(cells, kind)


PLACE = ["label", "size", "block", "cell"]


def _pairs_of_chunks(own: Column, chunks: Column, role: Column | None = None) -> Column:
    """Where a row of chunk ``own`` goes: structs ``i, j, as``.

    In (i, j) the first chunk's rows meet those of the second, and in (i, i) each other; guests of
    chunk j meet the first chunk's rows.
    """
    others = F.sequence(F.lit(0), chunks - 1)

    def pair(i: Column, j: Column, role: int) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), F.lit(role).cast("long").alias("as"))

    if role is None:
        later = F.transform(F.filter(others, lambda k: k >= own), lambda k: pair(own, k, FIRST))
    else:
        later = F.transform(others, lambda k: pair(own, k, FIRST))
    earlier = F.transform(F.filter(others, lambda k: k < own), lambda k: pair(k, own, SECOND))
    at_home = F.concat(later, earlier)
    if role is None:
        return at_home
    return F.when(role == FIRST, at_home).otherwise(F.transform(others, lambda k: pair(k, own, GUEST)))


def _chunked(placed: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of crowded cells in their pairs (i, j) of chunks; other cells are one chunk."""
    crowded = settle(counts.filter(F.col("vectors") > CELL), "crowded")
    rows = placed.join(small(crowded), PLACE, "left")
    rows = rows.withColumn("chunks", F.coalesce(F.ceil(F.col("vectors") / CELL), F.lit(1)).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("name"), F.col("chunks")).cast("int"))
    where = _pairs_of_chunks(F.col("own"), F.col("chunks"), F.col("role"))
    return rows.withColumn("w", F.explode(where)).select(
        *PLACE, "w.i", "w.j", F.col("w.as").alias("role"), "name", "steps"
    )


class Roots:
    """Sets of places that grow together; the smallest place names its set."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def of(self, places: np.ndarray) -> np.ndarray:
        root = self.parent[places]
        while (self.parent[root] != root).any():
            root = self.parent[root]
        self.parent[places] = root
        return root

    def link(self, p: np.ndarray, q: np.ndarray) -> None:
        """``p`` and ``q`` are roots."""
        nodes, roots = forest(p, q)
        self.parent[nodes] = roots


def _candidates(steps: np.ndarray, home: np.ndarray, others: np.ndarray, alike: bool, reach: float) -> Roots:
    """The sets of rows that are near in the block, by links of home rows with others and, if
    ``alike``, with each other."""
    roots = Roots(len(steps))
    along = steps[:, 1] if steps.shape[1] > 1 else np.zeros(len(steps), dtype=np.int8)
    home, others = (side[np.argsort(along[side], kind="stable")] for side in (home, others))
    keys = [along[side].astype(np.int64) for side in (home, others)]
    limit = reach**2 + 0.5
    for start in range(0, len(home), ROWS):
        rows = home[start : start + ROWS]
        first, last = keys[0][start] - reach, keys[0][start + len(rows) - 1] + reach
        inside = steps[rows].astype(np.float32)
        squares = (inside**2).sum(axis=1)
        for side, key in ((home, keys[0]), (others, keys[1])):
            if side is home and not alike:
                continue
            low = start if side is home else int(np.searchsorted(key, first))
            high = int(np.searchsorted(key, last, side="right"))
            for at in range(low, high, COLUMNS):
                columns = side[at : min(at + COLUMNS, high)]
                p, q = roots.of(rows), roots.of(columns)
                if p.min() == p.max() == q.min() == q.max():
                    continue
                outside = steps[columns].astype(np.float32)
                near = squares[:, None] + (outside**2).sum(axis=1)[None] - 2 * (inside @ outside.T) <= limit
                i, j = np.nonzero(near & (p[:, None] != q[None, :]))
                if len(i):
                    roots.link(p[i], q[j])
    return roots


def _met(cells: DataFrame, least: float) -> DataFrame:
    """``name`` and ``root`` of the vectors with candidates in a cell."""

    def join(key: tuple, rows: pa.Table) -> pa.Table:
        _, size, block, _, i, j = (k.as_py() for k in key)
        space = Space(size, least)
        # a class that several tasks have sent is one row
        name, place = np.unique(rows.column("name").to_numpy(), return_index=True)
        some = rows.take(pa.array(place))
        raw = b"".join(x.as_py() for x in some.column("steps"))
        steps = np.frombuffer(raw, dtype=np.int8).reshape(len(name), -1)
        role = some.column("role").to_numpy()
        home, others = np.flatnonzero(role == FIRST), np.flatnonzero(role != FIRST)
        roots = _candidates(steps, home, others, i == j, space.steps[block])
        own = roots.of(np.arange(len(name)))
        met = np.bincount(own, minlength=len(name))[own] > 1
        return pa.table({"name": name[met], "root": name[own[met]]})

    return cells.groupBy(*PLACE, "i", "j").applyInArrow(join, "name long, root long")


def _verified(vectors: np.ndarray, n: np.ndarray, first: int, alike: bool, least: float):
    """Links (with ``n`` of each partner) and smallest place reached, among the ``first`` rows and
    the others, or among all if ``alike``."""
    exact = unit(vectors)
    roots, links = Roots(len(exact)), np.zeros(len(exact), dtype=np.int64)
    for start in range(0, first, ROWS):
        stop = min(start + ROWS, first)
        for at in range(start if alike else first, len(exact), COLUMNS):
            end = min(at + COLUMNS, len(exact))
            cosines = exact[start:stop] @ exact[at:end].T
            for i, j in zip(*np.nonzero(np.abs(cosines - least) < CLOSE)):
                cosines[i, j] = (exact[start + i] * exact[at + j]).sum()
            near = cosines >= least
            if alike:  # each pair once
                near &= np.arange(start, stop)[:, None] < np.arange(at, end)[None, :]
            links[start:stop] += near @ n[at:end]
            links[at:end] += n[start:stop] @ near
            p, q = roots.of(np.arange(start, stop)), roots.of(np.arange(at, end))
            i, j = np.nonzero(near & (p[:, None] != q[None, :]))
            if len(i):
                roots.link(p[i], q[j])
    return links, roots.of(np.arange(len(exact)))


def _linked(members: DataFrame, least: float) -> DataFrame:
    """``name``, ``n_links`` and ``root`` of members (cluster, name, n, embedding) with links."""
    sizes = members.groupBy("cluster").agg(F.count("*").alias("m"))
    rows = members.join(small(settle(sizes.filter(F.col("m") > CHUNK), "large")), "cluster", "left")
    buckets = 1 + members.count() // CHUNK
    rows = rows.withColumn("chunks", F.coalesce(F.ceil(F.col("m") / CHUNK), F.lit(1)).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("name"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("w", F.explode(_pairs_of_chunks(F.col("own"), F.col("chunks"))))
    # many small clusters share a task; a large one has tasks of its own
    bucket = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(buckets))).otherwise(-1)
    home = F.when(F.col("chunks") > 1, F.col("cluster")).otherwise(0)
    rows = rows.select(
        bucket.cast("long").alias("bucket"), home.cast("long").alias("home"), "w.i", "w.j",
        F.col("w.as").alias("role"), "cluster", "name", "n", "embedding",
    )

    def verify(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[2].as_py(), key[3].as_py()
        rows = rows.combine_chunks().sort_by([("cluster", "ascending"), ("role", "ascending"), ("name", "ascending")])
        cluster, role, name, n = (rows.column(c).to_numpy() for c in ("cluster", "role", "name", "n"))
        edges = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1], [True]]))
        found = []
        for low, high in zip(edges[:-1], edges[1:]):
            vectors = _matrix(rows.column("embedding").slice(low, high - low))
            first = int((role[low:high] == FIRST).sum())
            links, roots = _verified(vectors, n[low:high], first, i == j, least)
            own = name[low:high]
            some = links > 0
            found.append((own[some], links[some], own[roots[some]]))
        columns = [np.concatenate(side) for side in zip(*found)]
        return pa.table(dict(zip(("name", "n_links", "root"), columns)))

    return rows.groupBy("bucket", "home", "i", "j").applyInArrow(verify, "name long, n_links long, root long")


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    named = _named(vectors.select(F.col("vec_id").cast("long"), "label", "embedding"))
    placed = _placed(named, least)
    counts = placed.groupBy(*PLACE).agg(F.count("*").alias("vectors"))
    met = settle(_met(_chunked(placed, counts), least), "met")
    clusters = settle(components(met.select(F.col("name").alias("a"), F.col("root").alias("b"))), "clusters")
    own = named.filter("name is not null")
    fetched = own.join(small(clusters, NAMES), own["name"] == clusters["node"]).groupBy("root", "name")
    members = settle(
        fetched.agg(F.count("*").alias("n"), F.first("embedding").alias("embedding")).withColumnRenamed(
            "root", "cluster"
        ),
        "members",
    )
    found = settle(_linked(members, least), "links")
    roots = components(found.select(F.col("name").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("name").agg(F.sum("n_links").alias("links"))
    classes = own.groupBy("name").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    known = (
        classes.join(links, "name", "left")
        .join(roots.withColumnRenamed("node", "name"), "name", "left")
        .filter("n > 1 or links is not null")
        .withColumn("root", F.coalesce("root", "name"))
    )
    known = settle(known, "known")
    least_of = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least_of, "root").select(
        "name", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    rows = named.select("vec_id", "name").join(small(settle(known, "known"), NAMES), "name", "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
