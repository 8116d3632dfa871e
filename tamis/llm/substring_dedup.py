"""Repeated passages go, found by suffix automata of reference shards.

A window is ``WINDOW`` consecutive words.  A word goes if a window that covers it also starts in a
document with a smaller id.  Every document is reference to those behind it, so the reference is
the corpus itself, and an automaton of it has no size bound.  Hence it is cut into shards, and a
document is streamed through those shards only that may hold its windows:

1. The key of a window is the smallest hash of its ``GRAM``-word grams, so equal windows have equal
   keys.  Windows in a row with one key make a segment, their words.  Keys that occur in two
   documents are set in a bitmap of ``BITS`` bits, which is broadcast; its size is fixed, and a full
   one lets more segments through, it loses none.
2. Segments whose key the bitmap shows are written once and grouped by key and words, with the
   smallest id that holds each.  Equal segments become one before they are shuffled.
3. A shard has the different segments of some keys, about ``SHARD`` words.  Its task builds the
   generalised suffix automaton, whose states know the smallest id they occur in, and streams the
   segments through it for matching statistics: the match at each word, cut to ``WINDOW`` words, is a
   state, and that state tells where the window occurs first.  A key with more than ``CROWD``
   different segments would make a shard without bound; its segments are cut into single windows,
   each with a key of its own.
4. What a segment's windows tell is joined with its occurrences (those in more than ``SPLIT`` places
   by a broadcast), and becomes the maximal spans of each document.

Automata are built where the shard's text is instead of being broadcast whole: sent to all tasks,
they would take as many passes over the corpus as there are shards.

Defined cases: a null or empty text has no words; fewer words than a window are kept; a row without
id keeps all words and is no reference; rows with one id are documents of their own, none of them
smaller than another; repeated rows get equal results; an empty table gives an empty result;
extra columns are ignored by :func:`cleaned` but for ``doc_id`` and ``text``.  A document must fit
in memory.  Exact but for collisions of 128-bit hashes of segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import settle, small

WINDOW = 13
#: Words of the grams among which a window's key is chosen.
GRAM = 6
#: Most windows of a segment; their marks fit into the low bits of a code.
RUN, CODE = 16, 16
BITS = 1 << 28
#: Words of a shard, different segments of a key that stay whole, and occurrences of a segment that
#: are joined by a shuffle.
SHARD, CROWD, SPLIT = 100_000, 4_096, 20_000
#: Bytes of texts whose windows are looked at together.
TOGETHER = 128_000
#: Bytes of spans that may be broadcast.
SPANS = 32_000_000
NOWHERE = 2**63 - 1


class Automaton:
    """The generalised suffix automaton of some word sequences, each with a document's id.

    ``length``, ``link`` and ``step`` are its states; ``first`` is the smallest id of a document
    that holds a state's words, ``cut`` the state of their last ``window`` words.
    """

    def __init__(self, texts: list[list[bytes]], ids: list[int], window: int = WINDOW):
        length, link, step, first = [0], [-1], [{}], [NOWHERE]
        for words, doc in zip(texts, ids):
            last = 0
            for word in words:
                after = step[last].get(word)
                if after is not None and length[after] == length[last] + 1:
                    last = after
                else:
                    if after is None:
                        own = len(length)
                        length.append(length[last] + 1)
                        link.append(0)
                        step.append({})
                        first.append(NOWHERE)
                        at = last
                        while at >= 0 and word not in step[at]:
                            step[at][word] = own
                            at = link[at]
                        if at >= 0:
                            after = step[at][word]
                            if length[after] != length[at] + 1:
                                after = self._split(length, link, step, first, at, after, word)
                            link[own] = after
                        last = own
                    else:
                        last = self._split(length, link, step, first, last, after, word)
                if doc < first[last]:
                    first[last] = doc
        order = np.argsort(np.array(length), kind="stable").tolist()
        for state in reversed(order[1:]):
            shorter = link[state]
            if first[state] < first[shorter]:
                first[shorter] = first[state]
        cut = list(range(len(length)))
        for state in order[1:]:
            if length[link[state]] >= window:
                cut[state] = cut[link[state]]
        self.length, self.link, self.step, self.first = length, link, step, first
        self.cut, self.window = cut, window

    @staticmethod
    def _split(length, link, step, first, at, after, word) -> int:
        """A state for the shorter words of ``after``, those that follow ``at``."""
        own = len(length)
        length.append(length[at] + 1)
        link.append(link[after])
        step.append(step[after].copy())
        first.append(NOWHERE)
        link[after] = own
        while at >= 0 and step[at].get(word) == after:
            step[at][word] = own
            at = link[at]
        return own

    def firsts(self, words: list[bytes]) -> list[int]:
        """For each window of a text, the smallest id of a document that holds it."""
        length, link, step = self.length, self.link, self.step
        state = matched = 0
        found = []
        for n, word in enumerate(words):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
            if n >= self.window - 1:
                found.append(self.first[self.cut[state]] if matched >= self.window else NOWHERE)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: What a byte adds to its word's hash, and the factor of its place in the word.
BYTES = np.where(SPACE, np.uint64(0), _mixed(np.arange(1, 257, dtype=np.uint64)))
PLACES = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64))
FACTORS = _mixed(np.arange(1, GRAM + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


class Windows:
    """The words and the windows' keys of some texts, all at once.

    ``first`` and ``end`` are the bytes of each word in ``joined``, ``starts`` the number of each
    text's first word.  A text of ``n`` words has the ``keys`` from its start on for
    ``n - WINDOW + 1`` windows.  Keys only choose where windows meet: that different ones may be
    equal does no harm.
    """

    def __init__(self, texts: list[bytes]):
        self.joined = b"\n".join([*texts, b""])
        raw = np.frombuffer(self.joined, dtype=np.uint8)
        space = np.concatenate([[True], SPACE[raw], [True]])
        edges = np.flatnonzero(space[1:] != space[:-1])
        self.first, self.end = edges[::2], edges[1::2]
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.starts = np.searchsorted(self.first, offsets)
        self.keys = np.zeros(0, dtype=np.uint64)
        if len(self.first) < WINDOW:
            return
        low = self.first[0]
        place = np.arange(low, len(raw)) - np.repeat(self.first, np.diff(self.first, append=len(raw)))
        values = BYTES[raw[low:]] * PLACES[place & 4095]
        h = _mixed(np.add.reduceat(values, self.first - low))
        grams = h[: len(h) - GRAM + 1] * FACTORS[0]
        for n in range(1, GRAM):
            grams += h[n : n + len(grams)] * FACTORS[n]
        least, width = _mixed(grams), 1
        while width < WINDOW - GRAM + 1:
            more = min(width, WINDOW - GRAM + 1 - width)
            least = np.minimum(least[:-more], least[more:])
            width += more
        self.keys = least


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``TOGETHER`` bytes of text, or one longer text."""
    sizes = np.cumsum(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + TOGETHER, side="right")))
        yield batch.slice(low, high - low)
        low = high


def runs(keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first window (counted over all texts) and number of windows of each segment."""
    counts = np.maximum(np.diff(starts) - WINDOW + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(text)) + np.repeat(starts[:-1] - np.cumsum(counts) + counts, counts)
    own = keys[at]
    fresh = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])])[: len(own)])
    sizes = np.diff(fresh, append=len(own))
    if (sizes > RUN).any():
        parts = -(-sizes // RUN)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        ends = np.repeat(fresh + sizes, parts)
        fresh = np.repeat(fresh, parts) + RUN * inner
        sizes = np.minimum(ends - fresh, RUN)
    return text[fresh], at[fresh], sizes


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("name"))


def shared_keys(texts: DataFrame) -> DataFrame:
    """``key`` of windows that occur in two documents or more (rows, here)."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, 0):
                windows = Windows([t.as_py() for t in part.column(0)])
                text, first, _ = runs(windows.keys, windows.starts)
                found = windows.keys[first]
                order = np.lexsort((found, text))  # a key is one of its text
                found, text = found[order], text[order]
                once = np.concatenate([[True], (found[1:] != found[:-1]) | (text[1:] != text[:-1])])[: len(found)]
                yield pa.RecordBatch.from_arrays([pa.array(found[once].view(np.int64))], ["key"])

    keys = texts.select("text").mapInArrow(own, "key long")
    return keys.groupBy("key").count().filter("count > 1").select("key")


def bitmap(keys: DataFrame) -> np.ndarray:
    """The bits of the keys' highest bits, in bytes."""
    shift = 64 - (BITS.bit_length() - 1)
    place = F.shiftrightunsigned("key", shift)
    bits = keys.select(
        F.shiftright(place, 6).alias("slot"),
        F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int")).alias("bit"),
    )
    # one row for each 64 bits at most, whatever the corpus
    rows = bits.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    whole = np.zeros(BITS // 64, dtype=np.int64)
    whole[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy()
    return whole


def _set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - (BITS.bit_length() - 1))
    own = bits[(place >> np.uint64(6)).astype(np.int64)].view(np.uint64)
    return (own >> (place & np.uint64(63))) & np.uint64(1) > 0


_SEGMENT = "doc_id long, name long, start int, key long, words binary"


def segments(texts: DataFrame, bits: np.ndarray) -> DataFrame:
    """Segments with a key in the bitmap: ``start`` is the first of its words."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for part in _pieces(batch, 1):
                windows = Windows([t.as_py() for t in part.column(1)])
                text, first, sizes = runs(windows.keys, windows.starts)
                some = np.flatnonzero(_set(own, windows.keys[first])) if len(first) else first
                text, first, sizes = text[some], first[some], sizes[some]
                low = windows.first[first].tolist()
                high = windows.end[first + sizes + WINDOW - 2].tolist() if len(first) else []
                joined = windows.joined
                place = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(place),
                        part.column(2).take(place),
                        pa.array((first - windows.starts[text]).astype(np.int32)),
                        pa.array(windows.keys[first].view(np.int64)),
                        pa.array([b" ".join(joined[a:b].split()) for a, b in zip(low, high)], pa.binary()),
                    ],
                    [field.split()[0] for field in _SEGMENT.split(", ")],
                )

    return texts.select("doc_id", "text", "name").filter("doc_id is not null").mapInArrow(cut, _SEGMENT)


def _hash() -> Column:
    return F.xxhash64("words").alias("hash")


def _windows(rows: DataFrame, *others: str) -> DataFrame:
    """Segments cut into single windows, each with a key of its own."""
    words = F.split(F.col("words").cast("string"), " ")
    last = F.size("w") - WINDOW
    cut = F.transform(
        F.sequence(F.lit(0), last),
        lambda n: F.struct(n.cast("int").alias("n"), F.array_join(F.slice("w", n + 1, WINDOW), " ").alias("words")),
    )
    rows = rows.withColumn("w", words).select(*others, F.explode(cut).alias("c"))
    own = F.col("c.words").cast("binary")
    kept = [(F.col(o) + F.col("c.n")).alias(o) if o == "start" else F.col(o) for o in others]
    return rows.select(*kept, F.xxhash64(F.lit(1), own).alias("key"), own.alias("words"))


def _first(rows: DataFrame) -> DataFrame:
    """Different segments with the smallest and largest id that holds them, and how often they occur."""
    return rows.groupBy("key", "words").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")
    )


def matched(different: DataFrame) -> DataFrame:
    """``key``, ``hash``, ``n`` and ``firsts`` (for each window, the smallest id of a document that
    holds it) of the (settled) segments in which a document may lose words."""
    size = F.length("words") - F.length(F.translate(F.col("words").cast("string"), " ", "")) + 1
    total = different.agg(F.sum(size)).first()[0] or 0
    shards = 1 + int(total) // SHARD

    def stream(rows: pa.Table) -> pa.Table:
        key, last = (rows.column(c).to_numpy() for c in ("key", "last"))
        first = rows.column("first").to_numpy()
        names, place = np.unique(key, return_inverse=True)
        low, high = np.full(len(names), NOWHERE), np.full(len(names), -NOWHERE)
        np.minimum.at(low, place, first)
        np.maximum.at(high, place, last)
        some = np.flatnonzero(low[place] < high[place])  # others only seemed to be shared
        texts = [t.as_py().split() for t in rows.column("words").take(pa.array(some))]
        automaton = Automaton(texts, first[some].tolist())
        firsts = [automaton.firsts(words) for words in texts]
        hit = [n for n, (own, most) in enumerate(zip(firsts, last[some].tolist())) if min(own) < most]
        chosen = rows.take(pa.array(some[hit], pa.int64())) if hit else rows.slice(0, 0)
        return pa.table(
            {
                "key": chosen.column("key"),
                "hash": chosen.column("hash"),
                "n": chosen.column("n"),
                "firsts": pa.array([firsts[n] for n in hit], pa.list_(pa.int64())),
            }
        )

    rows = different.select("key", "words", "first", "last", "n", _hash())
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return rows.groupBy("shard").applyInArrow(stream, "key long, hash long, n long, firsts array<long>")


def _marks(occurrences: DataFrame, told: DataFrame) -> DataFrame:
    """``doc_id``, ``name`` and ``code`` (start, and a bit for each window that goes) of segments."""
    key = ["key", "hash"]
    told = settle(told, "told")
    crowded = small(told.filter(F.col("n") > SPLIT))
    few = occurrences.join(crowded.drop("n"), key).unionByName(
        occurrences.join(crowded.select(*key), key, "left_anti").join(
            told.filter(F.col("n") <= SPLIT).drop("n"), key
        )
    )
    bit = F.transform(
        "firsts",
        lambda first, n: F.when(
            first < F.col("doc_id"), F.call_function("shiftleft", F.lit(1).cast("long"), n.cast("int"))
        ).otherwise(F.lit(0).cast("long")),
    )
    mask = F.aggregate(bit, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    code = F.shiftleft(F.col("start").cast("long"), CODE).bitwiseOR(mask)
    return few.select("doc_id", "name", code.alias("code")).filter(F.col("code").bitwiseAND(F.lit((1 << CODE) - 1)) > 0)


def _merged(codes: np.ndarray) -> np.ndarray:
    """Start and end, in turn, of the maximal spans that some codes' windows cover."""
    bits = (codes[:, None] >> np.arange(CODE)) & 1
    starts = np.unique(((codes >> CODE)[:, None] + np.arange(CODE))[bits > 0])
    fresh = np.concatenate([[True], starts[1:] > starts[:-1] + WINDOW])
    ends = starts[np.concatenate([fresh[1:], [True]])] + WINDOW
    return np.stack([starts[fresh], ends], axis=1).reshape(-1)


def spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``name`` (a hash of the text) and ``spans``: starts and ends of the word ranges
    that go, in turn; of documents that lose words."""
    texts = _texts(docs)
    found = settle(segments(texts, bitmap(shared_keys(texts))), "segments", compression="zstd")
    rows = found.select("key", "words", *(F.col("doc_id").alias(c) for c in ("first", "last")), F.lit(1).alias("n"))
    different = settle(_first(rows), "different")
    counts = different.groupBy("key").agg(F.count("*").alias("m"))
    crowd = small(settle(counts.filter(F.col("m") > CROWD).select("key"), "crowd"))
    whole = different.join(crowd, "key", "left_anti")
    cut = _first(_windows(different.join(crowd, "key"), "first", "last", "n"))
    told = matched(settle(whole.unionByName(cut), "different"))
    place = ["doc_id", "name", "start"]
    occurrences = (
        found.join(crowd, "key", "left_anti")
        .select(*place, "key", _hash())
        .unionByName(_windows(found.join(crowd, "key"), *place).select(*place, "key", _hash()))
    )
    codes = _marks(occurrences, told).groupBy("doc_id", "name").agg(F.collect_set("code").alias("codes"))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_merged(x.values.to_numpy()) for x in batch.column(2)]
            edges = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int64), *own])
            ranges = pa.ListArray.from_arrays(edges, pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ranges], ["doc_id", "name", "spans"])

    return settle(codes.mapInArrow(merged, "doc_id long, name long, spans array<long>"), "spans")


def cleaned(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed`` and the kept ``text``, its words
    joined by one space."""
    found = spans(docs)
    size = found.agg(F.sum(F.size("spans") * 8 + 24)).first()[0] or 0
    rows = _texts(docs).join(F.broadcast(found) if size <= SPANS else found, ["doc_id", "name"], "left")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _pieces(batch, 1):
                sizes, removed, texts = [], [], []
                for text, ranges in zip(part.column(1), part.column(2)):
                    words = text.as_py().split()
                    sizes.append(len(words))
                    if ranges.is_valid:
                        edges = ranges.values.to_numpy().tolist()
                        for a, b in zip(edges[-2::-2], edges[::-2]):
                            del words[a:b]
                    removed.append(sizes[-1] - len(words))
                    texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(texts, pa.binary()),
                    ],
                    ["doc_id", "n_words", "n_removed", "text"],
                )

    schema = "doc_id long, n_words long, n_removed long, text binary"
    found = rows.select("doc_id", "text", "spans").mapInArrow(kept, schema)
    return found.withColumn("text", F.col("text").cast("string"))


def digest(rows: DataFrame) -> DataFrame:
    """What :func:`cleaned` gives, with a hash in place of the text."""
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
