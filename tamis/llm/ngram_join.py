"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct shingles.  Documents with equal sets are
one class.  Sets are sorted into bands by size; in a band of ``P`` parts, each shingle belongs to
one part by its hash, and the XOR of a part's hashes is one block of the parity sketch.  Each shingle in which
two sets differ changes one block at most, so the number of differing blocks is a lower bound of
the symmetric difference.  The smaller set's size ``n`` bounds that difference by ``D(n)`` for
linked sets; thus of any ``D(n) + 1`` blocks one is equal.  Sets meet on equal blocks among their
first ``E(n) = D(n) + 1 + s``, in their own band and, as the smaller one, in the next.  Thanks to
``s`` more blocks than needed, sets leave out their lightest ones, which many unlike sets share.

Blocks with the same sets count as one.  One byte of each block tells, by the Hamming distance of
bytes, which of the sets that meet may link at all; these pairs, as rows for two sets and as a few
links within larger blocks, make clusters.  A cluster's whole sets are sent to one group (a large
one's to groups of two chunks each, a huge one's by the blocks in which they meet) and compared
exactly there: intersections are a product of matrices, and each set is linked with the smallest
one it reaches.  No pairs are written; what shares a block and may link is compared.

Defined cases: a null text is an empty one; a document without words has an empty set and links
with nothing; documents with fewer words than a shingle have one shingle of all their words; rows
without id link as others do, but a null is no one's smallest id unless all ids of a component are
null; rows with one id are documents of their own; an empty table gives an empty result; extra
columns are ignored by :func:`groups` and kept by :func:`distinct_documents`.  A document must fit
in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import WORD, settle, small
from tamis.llm.components import components

#: Upper to lower end of a size band.
RATIO = 1.3
#: Words whose hashes a task keeps, and classes it has emitted.
CACHE = 500_000
#: Pairs or classes, of two numbers each, that may be broadcast.
BROADCAST = 500_000
#: Sets of one chunk of a group, shingles in all of them, and columns of a matrix.
CROWD, SHINGLES, COLUMNS = 1024, 1_000_000, 2048
#: Chunks of a cluster that is compared as a whole, and rows of blocks that go to one group.
CHUNKS, ROWS = 16, 1_000


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; sets link if ``100 * intersection >= percent * union``."""

    words: int = 5
    percent: int = 80

    def differ(self, n: int) -> int:
        """Most shingles in which a set of ``n`` differs from a larger linked one."""
        return n * (100 - self.percent) // self.percent

    @staticmethod
    def spare(differ: int) -> int:
        return 1 + differ // 6

    def blocks(self, n: int) -> int:
        differ = self.differ(n)
        return differ + 1 + self.spare(differ)

    def band(self, n: int) -> tuple[int, int, int]:
        """Number, end and parts of the band of sets of size ``n``."""
        low, number = 1, 0
        while True:
            high = max(low + 1, int(low * RATIO + 0.999))
            if n < high:
                return number, high, self.blocks(high - 1)
            low, number = high, number + 1

    def linked(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)

    def apart(self, a, b):
        """Most shingles in which linked sets of these sizes differ."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingles:
    """Sets of shingle hashes, sorted."""

    def __init__(self, rule: Rule):
        self.rule = rule
        self._known: dict[bytes, bytes] = {}
        # odd factors, one for each place in a shingle
        places = np.arange(1, rule.words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self._factors = _mixed(places) | np.uint64(1)

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self._known
        if len(known) > CACHE:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_digest(word)
        h = np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=np.uint64)
        size = min(self.rule.words, len(h))
        shingles = h[: len(h) - size + 1] * self._factors[0]
        for n in range(1, size):
            shingles += h[n : n + len(shingles)] * self._factors[n]
        shingles = np.sort(_mixed(shingles))
        return shingles[np.concatenate([[True], shingles[1:] != shingles[:-1]])]


def _class_of(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - 2**63


class Sketches:
    """The block keys of a set in its own band and those that a larger linked set may have.

    Besides, one byte of each block, in the order of bands and parts.
    """

    def __init__(self, rule: Rule):
        self.rule = rule
        self._edges: dict[int, np.ndarray] = {}

    def _bands(self, n: int) -> list[tuple[int, int, bool]]:
        """Number and parts of each band that the set belongs to, its own one first."""
        number, high, parts = self.rule.band(n)
        most = n * 100 // self.rule.percent  # the largest set it may link with
        bands = [(number, parts, True)]
        while most >= high:
            number, high, parts = self.rule.band(high)
            bands.append((number, parts, False))
        return bands

    def _starts(self, parts: int) -> np.ndarray:
        """The smallest hash of each part: parts are equal ranges of hashes."""
        if parts not in self._edges:
            self._edges[parts] = np.array([(p << 64) // parts for p in range(parts)], dtype=np.uint64)
        return self._edges[parts]

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, bytes]:
        n, rule = len(hashes), self.rule
        if not rule.differ(n):
            return hashes[:0], b""  # links with equal sets only
        found, marks = [], []
        for number, parts, own in self._bands(n):
            starts = np.searchsorted(hashes, self._starts(parts))
            counts = np.diff(starts, append=n)
            block = np.zeros(parts, dtype=np.uint64)
            filled = counts > 0
            block[filled] = np.bitwise_xor.reduceat(hashes, starts[filled])
            shown = counts[: rule.blocks(n)]
            emitted = np.flatnonzero(shown > self._light(shown, n, own))
            place = _mixed(emitted.astype(np.uint64) + np.uint64(number << 32))
            found.append(_mixed(block[emitted] ^ place) + place)
            marks.append(block[: len(shown)].astype(np.uint8).tobytes())
        return np.concatenate(found), b"".join(marks)

    def _light(self, counts: np.ndarray, n: int, own: bool) -> int:
        """Blocks of at most so many shingles may be left out; -1 if none may.

        It is the largest number for which, whatever the size of the smaller set of a pair,
        at most ``s`` of the blocks that one emits are as light.  Let the heaviest of a pair's
        ``s + 1`` equal blocks, which are equally heavy in both sets, have ``z`` shingles: then
        more than ``s`` blocks have at most ``z``, both sets stay below ``z``, and both show that
        block.  In the next band the set is always the smaller one.
        """
        rule, most = self.rule, self.rule.differ(n)
        least = rule.differ(-(-n * rule.percent // 100)) if own else most
        differ = np.arange(least, most + 1)
        spare = 1 + differ // 6
        for light in range(int(counts.max()) + 1):
            if (np.cumsum(counts <= light)[differ + spare] > spare).any():
                return light - 1
        return int(counts.max())


def _text() -> Column:
    return F.coalesce("text", F.lit("")).cast("binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), _text().alias("text"))


def sketched(docs: DataFrame, rule: Rule) -> DataFrame:
    """One row per document: ``doc_id``, a hash of its ``text``, ``n_shingles``, ``class`` (a hash
    of the set), the ``keys`` of its blocks and the ``marks`` that their bytes are; a task gives
    those of a class once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sketches, seen = Shingles(rule), Sketches(rule), set()
        none = np.zeros(0, dtype=np.int64)
        for batch in batches:
            sizes, names, keys, marks = [], [], [], []
            for text in batch.column(1):
                hashes = shingles.of(text.as_py())
                name = _class_of(hashes) if len(hashes) else None
                fresh = name is not None and name not in seen
                sizes.append(len(hashes))
                names.append(name)
                own, mark = sketches.of(hashes) if fresh else (none, None)
                keys.append(own.view(np.int64))
                marks.append(mark)
                seen.add(name)
            if len(seen) > CACHE:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.ListArray.from_arrays(
                        np.concatenate([[0], np.cumsum(list(map(len, keys)))]).astype(np.int32),
                        pa.array(np.concatenate([none, *keys])),
                    ),
                    pa.array(marks, pa.binary()),
                ],
                ["doc_id", "text", "n_shingles", "class", "keys", "marks"],
            )

    kind = "doc_id long, text long, n_shingles long, class long, keys array<long>, marks binary"
    return _texts(docs).select("*", F.xxhash64("text")).mapInArrow(rows, kind)


def meetings(rows: DataFrame) -> DataFrame:
    """The classes of each block that has several: ``key`` (one for blocks of the same classes),
    ``size``, ``class`` and ``other``, the block's first one."""
    keys = rows.select(F.explode("keys").alias("key"), "class")
    by_key = Window.partitionBy("key")
    once = F.lag("class").over(by_key.orderBy("class"))
    keys = keys.withColumn("last", once).filter("last is null or last <> class")
    found = keys.select(
        "class",
        F.count("*").over(by_key).alias("size"),
        F.min("class").over(by_key).alias("other"),
        F.bit_xor(F.xxhash64("class")).over(by_key).alias("key"),
    )
    return found.filter("size > 1").select("key", "size", "class", "other").distinct()


def _sets(docs: DataFrame, chosen: DataFrame, rule: Rule) -> DataFrame:
    """``class`` and ``hashes`` of the chosen classes (class, text: the hash of one that has it)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(rule), set()
        for batch in batches:
            names, sets = [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # rows with this text may be many
                if name not in seen and _class_of(hashes := shingles.of(text.as_py())) == name:
                    seen.add(name)
                    names.append(name)
                    sets.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(sets, pa.binary())], ["class", "hashes"]
            )

    texts = docs.select(_text().alias("words"), F.xxhash64(_text()).alias("text"))
    rows = texts.join(small(chosen, BROADCAST), "text").select("class", "words")
    return rows.mapInArrow(hashed, "class long, hashes binary")


def _close_pairs(pairs: DataFrame, names: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose marks differ in no more bytes than linked sets could."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("na", "nb", "ma", "mb"))
            keep = [_close(rule, *row) for row in zip(*columns)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    for side in "ab":
        known = names.select(
            F.col("class").alias(side), F.col("n").alias(f"n{side}"), F.col("marks").alias(f"m{side}")
        )
        pairs = pairs.join(known, side)
    possible = 100 * F.least("na", "nb") >= rule.percent * F.greatest("na", "nb")
    return pairs.filter(possible).mapInArrow(close, "a long, b long")


def _close(rule: Rule, na: int, nb: int, ma: bytes, mb: bytes) -> bool:
    (small_n, small_m), (large_n, large_m) = sorted(((na, ma), (nb, mb)), key=lambda x: x[0])
    size = rule.blocks(small_n)
    band = rule.band(large_n)[0] - rule.band(small_n)[0]
    left = np.frombuffer(small_m, dtype=np.uint8)[band * size : (band + 1) * size]
    right = np.frombuffer(large_m, dtype=np.uint8)[:size]
    return np.count_nonzero(left != right) <= rule.apart(na, nb)


def _spanning(names: np.ndarray, near: Callable[[slice], np.ndarray], rows: int) -> np.ndarray:
    """The smallest name that each one reaches; ``near`` gives some rows of the matrix of links,
    at most ``rows`` at once."""
    root = names.copy()
    while True:
        before = root.copy()
        for at in range(0, len(names), rows):
            own = slice(at, at + rows)
            linked = near(own)
            least = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1)
            root[own] = np.minimum(root[own], least)
        if (before == root).all():
            return root


def _close_in_blocks(members: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) that hold those sets of a block together whose marks are close.

    ``members`` has ``key``, ``size``, ``class``, ``n`` and ``marks``; many blocks go to one
    group, and large ones in chunks.
    """

    def close(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending")])
        place = np.stack([rows.column(c).to_numpy() for c in ("key", "i", "j")])
        edges = np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1
        none = np.zeros(0, dtype=np.int64)
        found = [(none, none)]
        for start, stop in zip([0, *edges], [*edges, rows.num_rows]):
            own = rows.slice(start, stop - start)
            names, n = own.column("class").to_numpy(), own.column("n").to_numpy()
            root = _spanning(names, *_close_marks(rule, n, own.column("marks").to_pylist()))
            some = root != names
            found.append((names[some], root[some]))
        a, b = (np.concatenate(side) for side in zip(*found))
        return pa.table({"a": a, "b": b})

    chunks = F.ceil(F.col("size") / CROWD).cast("int")
    rows = settle(_paired(members.withColumn("chunks", chunks)), "members")
    groups = 1 + rows.count() // ROWS
    bucket = F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups)).alias("bucket")
    rows = rows.select("key", "i", "j", "class", "n", "marks", bucket)
    return rows.groupBy("bucket").applyInArrow(close, "a long, b long")


def _close_marks(rule: Rule, n: np.ndarray, marks: list[bytes]):
    """The rows of the matrix that tells whose marks are close, and how many to take at once."""
    numbers = {int(x): rule.band(int(x))[0] for x in np.unique(n)}
    bands = np.array([numbers[int(x)] for x in n])
    blocks = np.array([rule.blocks(int(x)) for x in n])
    offset = (bands.max() - bands) * blocks
    table = np.zeros((len(n), blocks.max()), dtype=np.uint8)
    for row, mark, start, size in zip(table, marks, offset, blocks):
        row[:size] = np.frombuffer(mark, dtype=np.uint8)[start : start + size]
    shown = np.arange(blocks.max()) < blocks[:, None]

    def near(own: slice) -> np.ndarray:
        both = shown[own, None, :] & shown[None, :, :]  # as many as the smaller set shows
        far = ((table[own, None, :] != table[None, :, :]) & both).sum(axis=2)
        return far <= rule.apart(n[own, None], n[None, :])

    return near, max(1, 20_000_000 // table.size)


def _in_chunks(members: DataFrame, by: str, most: int | None = None) -> DataFrame:
    """Members with ``i`` and ``j``: large groups as pairs of chunks, others as one.

    Groups of more than ``most`` chunks are left out.
    """
    size = F.greatest(F.ceil(F.count("*") / CROWD), F.ceil(F.sum("n") / SHINGLES))
    counts = members.groupBy(by).agg(size.cast("int").alias("chunks")).filter("chunks > 1")
    rows = members.join(small(settle(counts, "counts")), by, "left")
    rows = rows.withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    if most is not None:
        rows = rows.filter(F.col("chunks") <= most)
    return _paired(rows)


def _paired(members: DataFrame) -> DataFrame:
    """Members once for each pair (i, j) of ``chunks`` that theirs is one of."""
    columns = [c for c in members.columns if c != "chunks"]
    own = F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int").alias("own")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other_chunk")
    rows = members.select(*columns, own, other)
    i, j = F.least("own", "other_chunk").alias("i"), F.greatest("own", "other_chunk").alias("j")
    return rows.select(*columns, i, j)


def _compared(members: DataFrame, by: str, docs: DataFrame, names: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) within groups (``by``, i, j): each set with the smallest one it reaches."""

    def joined(rows: pa.Table) -> pa.Table:
        names, first = np.unique(rows.column("class").to_numpy(), return_index=True)
        sets = [np.frombuffer(rows.column("hashes")[int(n)].as_buffer(), dtype=np.uint64) for n in first]
        sizes = np.array([len(x) for x in sets])
        common = _intersections(sets, sizes)
        near = lambda own: rule.linked(common[own].astype(np.int64), sizes[own, None], sizes[None, :])
        root = _spanning(names, near, 512)
        some = root != names
        return pa.table({"a": names[some], "b": root[some]})

    chosen = names.join(members.select("class").distinct(), "class", "left_semi")
    chosen = settle(chosen.select("class", "text"), "chosen")
    sets = _sets(docs, chosen, rule)
    rows = sets.join(small(members.select(by, "class", "i", "j"), BROADCAST), "class")
    return rows.groupBy(by, "i", "j").applyInArrow(joined, "a long, b long")


def _intersections(sets: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """The size of each two sets' intersection."""
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(sets)), sizes)
    everywhere = int((counts == len(sets)).sum())
    common = np.full((len(sets), len(sets)), everywhere, dtype=np.float32)
    # hashes in one set only don't count, those in all of them are counted already
    wanted = (counts > 1) & (counts < len(sets))
    place = np.cumsum(wanted) - 1
    chosen = wanted[column]
    member, column = member[chosen], place[column[chosen]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    for at in range(0, int(wanted.sum()), COLUMNS):
        start, stop = np.searchsorted(column, [at, at + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[member[start:stop], column[start:stop] - at] = 1
        common += part @ part.T
    np.fill_diagonal(common, sizes)
    return common


def links(docs: DataFrame, rows: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between classes that have the same components as all links.

    ``rows`` are the (settled) sketched documents.
    """
    met = settle(meetings(rows), "meetings")
    met_classes = met.select("class").distinct()
    names = rows.join(met_classes, "class", "left_semi").groupBy("class").agg(
        F.min("text").alias("text"), F.min("n_shingles").alias("n"), F.max("marks").alias("marks")
    )
    names = settle(names, "names")
    pairs = met.filter("size = 2 and class <> other")
    pairs = pairs.select(F.col("class").alias("a"), F.col("other").alias("b"))
    met = met.filter("size > 2").select("key", "size", "class")
    near = _close_in_blocks(met.join(names.select("class", "n", "marks"), "class"), rule)
    near = settle(_close_pairs(pairs, names, rule).unionByName(near), "near")

    clusters = components(near).withColumnRenamed("node", "class")
    clusters = settle(clusters.join(names.select("class", "n"), "class"), "clusters")
    groups = settle(_in_chunks(clusters, "root", CHUNKS), "groups")
    found = settle(_compared(groups, "root", docs, names, rule), "found")
    huge = clusters.join(groups.select("class"), "class", "left_anti").select("class", "n")
    huge = settle(huge, "huge")
    if huge.isEmpty():
        return found
    two = near.select(F.xxhash64("a", "b").alias("key"), F.explode(F.array("a", "b")).alias("class"))
    rest = met.select("key", "class").unionByName(two).distinct().join(huge, "class")
    rest = settle(_in_chunks(rest, "key"), "rest")
    return found.unionByName(settle(_compared(rest, "key", docs, names, rule), "found"))


def _grouped(docs: DataFrame, rule: Rule) -> DataFrame:
    """The sketched documents with the ``root`` class of their component, null for empty sets, and
    ``component_id``."""
    rows = settle(sketched(docs, rule), "sketches")
    roots = components(links(docs, rows, rule))
    least = rows.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "least", F.coalesce("root", "class").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("class", "root", "component_id")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(named, "class", "left").select(
        "doc_id", "text", "n_shingles", "root", component.alias("component_id")
    )


def groups(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``."""
    return _grouped(docs, rule).select("doc_id", "n_shingles", "component_id")


def distinct_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    Of several rows with that id in the component, one stays; rows with that id in other
    components are documents of those.  Rows without an id go if their component has one with an
    id, else one of them stays; those without words, which link with nothing, all stay.
    """
    kept = _grouped(docs, rule)
    kept = kept.filter("doc_id <=> component_id and (root is not null or doc_id is not null)")
    # an empty set is a component of its own
    alone = [F.when(F.col("root").isNull(), F.col(c)).alias(f"_{c}") for c in ("doc_id", "text")]
    kept = kept.groupBy("root", *alone).agg(
        F.min("doc_id").alias("_id"), F.min("text").alias("_hash"), F.count("*").alias("n")
    )
    kept = settle(kept.select("_id", "_hash", "n"), "kept")
    own = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", F.xxhash64(_text()).alias("hash"))
    is_kept = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    # up to BROADCAST documents' ids are sent to the texts, of more the texts are shuffled to them
    ids = settle(kept.filter("n = 1").select("_id", "_hash"), "ids")
    single = own.join(small(ids, BROADCAST), is_kept, "left_semi").select("_row")
    repeated = own.join(small(settle(kept.filter("n > 1"), "repeated")), is_kept, "left_semi")
    one = repeated.groupBy("doc_id", "hash").agg(F.min("_row").alias("_row")).select("_row")
    empty = ~F.col("_row.text").rlike(WORD) | F.col("_row.text").isNull()
    nameless = own.filter(F.col("doc_id").isNull() & empty).select("_row")
    return single.unionByName(one).unionByName(nameless).select("_row.*")
