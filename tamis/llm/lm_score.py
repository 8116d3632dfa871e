"""Language-model scores from a log-frequency Bloom filter.

Unigram probabilities are exact, whatever the size of the vocabulary.  All bigrams that occur
twice or more in the training documents count, each with the smallest count of its level,
``1 + floor(log(n / 2) / log(BASE))``.  The model discounts these counts and gives the rest of a
history's mass to the unigrams:
``P(w | h) = (max(q(h, w) - DISCOUNT, 0) + (c(h) - kept(h)) * P(w)) / c(h)``; unseen histories have
no bigrams, so that there ``P(w | h) = P(w)``.  Sums over words are 1.

Where a bigram is looked up depends on the room, what it counts does not.  Those of the ``KNOWN``
most frequent tokens that occur ``least`` times or more are entered once for each level, as
(bigram, 1), (bigram, 2), ..., into a Bloom filter of ``BITS`` bits that every worker gets; probing
until one is absent gives the level back.  ``least`` is the smallest count for which the filter has
``ROOM`` bits for each entry.  All others stay in a table, as a key and what they add to the score
of their word; the bigrams of a document that a sieve does not rule out become rows that are
joined with it.  A full sieve lets more rows through, it loses none.

Known tokens are looked up in the task; a document's other tokens become rows that are joined
with the counts of all tokens, which are never gathered in one place.  There and in the table of
bigrams they are told apart by 63-bit hashes (bigrams) or their bytes (counts).

Tokens of more than ``LONG`` bytes are told apart by their start and 128 bits.

Defined cases: a null or empty text is its end token alone; a null id is held out; rows with one
id are scored each; without training documents all counts are 0; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import settle

ADD = 0.1
HELD_OUT = 10
END = b""
#: Tokens whose bigrams the filter may hold, at most; their numbers have 18 bits.
KNOWN = 1 << 18
#: Larger counts of a bigram count as this; its level would be the 54th.
MOST = (1 << 32) - 1
#: Bits of the filter and at least so many for an entry; probes of an entry; parts of the filter.
BITS, ROOM, PROBES, PARTS = 1 << 28, 10, 5, 1024
BASE, DISCOUNT = 1.5, 0.75
#: The smallest count of a bigram that the model keeps.
TWICE = 2
#: Bits of the sieve for bigrams outside the filter, and probes of a bigram.
SIEVE, SIFTS = 1 << 28, 2
#: Different tokens, or bigrams, that a task holds before it hands them on.
HELD = 1_000_000
#: Bytes of text whose tokens a task holds.
BYTES = 1 << 28
#: Bytes of a token; what is sent and kept of a longer one has one byte more.
LONG = 64
#: Tokens that are scored at once.
BATCH = 200_000

PAIR_BITS = 36
REST_BITS = 26
MASK = np.uint64((1 << PAIR_BITS) - 1)
#: Multiplying by an odd number and by its inverse permutes the pairs and puts them back.
ODD = 0x9E3779B97 | 1
BACK = pow(ODD, -1, 1 << PAIR_BITS)
#: The sign bit, which the hash of a token without a number has; parts of bigrams' keys.
SIGN = 1 << 63
KEY_BITS = 54


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % HELD_OUT == 0


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), text)


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def _short(token: bytes) -> bytes:
    """The token, or the start and 128 bits of a long one."""
    if len(token) <= LONG:
        return token
    return token[: LONG - 15] + blake2b(token, digest_size=16).digest()


def token_counts(train: DataFrame) -> DataFrame:
    """``token`` and ``n`` over all training texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            found, n = [*map(_short, counts)], list(counts.values())
            columns = [pa.array(found, pa.binary()), pa.array(n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["token", "n"])

        size = 0
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                counts.update(tokens(text))
                size += len(text)
            if len(counts) > HELD or size > BYTES:
                yield rows()
                counts.clear()
                size = 0
        yield rows()

    found = train.select("text").mapInArrow(counted, "token binary, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, most: int) -> tuple[list[bytes], np.ndarray]:
    """The tokens that occur so often that at most ``most`` do, and their counts; always the end.

    Counts are grouped by their logarithm, so the groups are few.
    """
    level = F.floor(F.log2("n") * 64)
    groups = counts.groupBy(level.alias("level")).agg(F.count("*").alias("tokens")).collect()
    least, total = float("inf"), 1
    for row in sorted(groups, key=lambda r: -r["level"]):
        total += row["tokens"]
        if total > most:
            break
        least = row["level"]
    chosen = counts.filter((level >= F.lit(float(least))) | (F.col("token") == F.lit(bytearray(END))))
    rows = chosen.orderBy(F.desc("n"), "token").collect()
    return [bytes(r["token"]) for r in rows], np.array([r["n"] for r in rows], dtype=np.float64)


def _numbers(known: dict[bytes, int], words: list[bytes]) -> np.ndarray:
    numbers = np.fromiter((known.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    for n in np.flatnonzero(numbers < 0).tolist():
        if len(words[n]) > LONG:
            numbers[n] = known.get(_short(words[n]), -1)
    return numbers


def _ids(numbers: np.ndarray, words: list[bytes]) -> np.ndarray:
    """The numbers of known tokens; the hashes of others, which are negative."""
    ids = numbers.copy()
    other = np.flatnonzero(numbers < 0)
    hashes = (xxhash.xxh64_intdigest(_short(words[n]), 42) | SIGN for n in other.tolist())
    ids[other] = np.fromiter(hashes, dtype=np.uint64, count=len(other)).view(np.int64)
    return ids


def _id(token: str) -> Column:
    """What :func:`_ids` gives a token without a number."""
    return F.xxhash64(token).bitwiseOR(F.lit(-SIGN))


def _keys(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64 bits for each bigram of two ids."""
    return _mixed(_mixed(history.view(np.uint64)) + word.view(np.uint64) * np.uint64(ODD))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pairs(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One permuted number for each bigram; its high bits are the filter's part."""
    pair = history.astype(np.uint64) * np.uint64(KNOWN) + word.astype(np.uint64)
    return (pair * np.uint64(ODD)) & MASK


def _sides(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = (pairs * np.uint64(BACK)) & MASK
    return tuple(side.astype(np.int64) for side in np.divmod(both, np.uint64(KNOWN)))


def _histories(pairs: np.ndarray) -> np.ndarray:
    return _sides(pairs)[0]


def bigram_counts(train: DataFrame, known: list[bytes]) -> DataFrame:
    """``part``, ``pairs`` and ``counts`` (32-bit numbers) of bigrams that occur at least twice.

    ``pairs`` are 32-bit numbers in the first ``PARTS`` parts, which hold the bigrams of known
    tokens; further ``PARTS`` parts hold the others as two ids each.  A task counts the bigrams it
    holds and hands them on as one row for each part.
    """
    shared = train.sparkSession.sparkContext.broadcast(known)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {token: n for n, token in enumerate(shared.value)}
        held, rest, size = [], [], 0
        for batch in batches:
            for text in batch.column(0):
                words = [END, *tokens(text.as_py())]
                found = _numbers(number, words)
                history, word = found[:-1], found[1:]
                both = (history >= 0) & (word >= 0)
                held.append(_pairs(history[both], word[both]))
                if len(held[-1]) < len(history):
                    ids = _ids(found, words)
                    rest.append(np.stack([ids[:-1][~both], ids[1:][~both]], axis=1))
                size += len(history)
                if size > 4 * HELD:
                    yield from _by_part(held, rest)
                    held, rest, size = [], [], 0
        if size:
            yield from _by_part(held, rest)

    def _by_part(held: list[np.ndarray], rest: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.unique(np.concatenate(held), return_counts=True)
        yield _cut(pairs, REST_BITS, 0, pairs.astype(np.uint32) & np.uint32((1 << REST_BITS) - 1), counts)
        if rest:
            pairs = np.concatenate(rest)
            keys, first, counts = np.unique(_keys(*pairs.T.copy()), return_index=True, return_counts=True)
            yield _cut(keys, KEY_BITS, PARTS, pairs[first], counts)

    def _cut(order: np.ndarray, bits: int, start: int, pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        edges = np.searchsorted(order >> np.uint64(bits), np.arange(PARTS + 1, dtype=np.uint64))
        parts = [p for p in range(PARTS) if edges[p] < edges[p + 1]]
        cut = [[x[edges[p] : edges[p + 1]].tobytes() for p in parts] for x in (pairs, counts.astype(np.uint32))]
        columns = [pa.array([start + p for p in parts], pa.int64()), *(pa.array(c, pa.binary()) for c in cut)]
        return pa.RecordBatch.from_arrays(columns, ["part", "pairs", "counts"])

    def merged(rows: pa.Table) -> pa.Table:
        of_known = rows.column("part")[0].as_py() < PARTS
        pairs, counts = (
            np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for x in rows.column(c)])
            for c, kind in (("pairs", np.uint32 if of_known else np.int64), ("counts", np.uint32))
        )
        if not of_known:
            pairs = pairs.reshape(-1, 2)
        keys = pairs if of_known else _keys(*pairs.T.copy())
        _, first, where = np.unique(keys, return_index=True, return_inverse=True)
        totals = np.minimum(np.bincount(where, counts, len(first)), MOST)
        often = totals >= TWICE
        return pa.table(
            {
                "part": rows.column("part")[:1],
                "pairs": pa.array([pairs[first][often].tobytes()], pa.binary()),
                "counts": pa.array([totals[often].astype(np.uint32).tobytes()], pa.binary()),
            }
        )

    schema = "part long, pairs binary, counts binary"
    return train.select("text").mapInArrow(local, schema).groupBy("part").applyInArrow(merged, schema)


def _levels(counts: np.ndarray, least: int) -> np.ndarray:
    """The level of each count, from 1 for that of ``least``."""
    level, first = (np.floor(np.log(n / TWICE) / log(BASE) + 1e-9).astype(np.int64) for n in (counts, least))
    return 1 + level - first


def _values(levels: int, least: int) -> np.ndarray:
    """The count that each level stands for, its smallest; 0 for level 0."""
    first = _levels(np.array([least]), TWICE)[0] - 1
    return np.concatenate([[0.0], np.ceil(TWICE * BASE ** (first + np.arange(levels)) - 1e-9)])


def _least(bigrams: DataFrame) -> int:
    """The smallest count, of those that begin a level, whose bigrams have room in the filter."""

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                counts = np.frombuffer(x.as_buffer(), dtype=np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.astype(np.int64)) for a in np.unique(_levels(counts, TWICE), return_counts=True)],
                    ["level", "bigrams"],
                )

    tally = bigrams.filter(F.col("part") < PARTS).select("counts").mapInArrow(tallied, "level long, bigrams long")
    rows = tally.groupBy("level").agg(F.sum("bigrams").alias("bigrams")).collect()
    first = 1
    while sum((r["level"] - first + 1) * r["bigrams"] for r in rows if r["level"] >= first) * ROOM > BITS:
        first += 1
    return int(_values(first, TWICE)[first])


def _positions(pairs: np.ndarray, level: int, probe: int) -> np.ndarray:
    """Bits in the filter's part of each pair."""
    size = BITS // PARTS
    h = _mixed(pairs + np.uint64((level << 44) + (probe << 40)) + np.uint64(0x9E3779B97F4A7C15))
    return (h % np.uint64(size)).astype(np.int64)


def _sieve_bits(keys: np.ndarray, probe: int) -> np.ndarray:
    """Bits in the sieve's part of each bigram."""
    return (_mixed(keys + np.uint64(probe + 1)) % np.uint64(SIEVE // (2 * PARTS))).astype(np.int64)


def build(bigrams: DataFrame, least: int) -> tuple[np.ndarray, int]:
    """The filter's bytes and its highest level."""
    size = BITS // PARTS

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pairs, counts in zip(*(batch.column(c).to_pylist() for c in range(3))):
                pairs, levels = _entries(part, pairs, counts, least)
                bits = np.zeros(size, dtype=bool)
                for level in range(1, int(levels.max(initial=0)) + 1):
                    for probe in range(PROBES):
                        bits[_positions(pairs[levels >= level], level, probe)] = True
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int64()),
                        pa.array([int(levels.max(initial=0))], pa.int64()),
                        pa.array([np.packbits(bits).tobytes()], pa.binary()),
                    ],
                    ["part", "levels", "bits"],
                )

    own = bigrams.filter(F.col("part") < PARTS)
    rows = own.mapInArrow(filtered, "part long, levels long, bits binary").collect()
    whole = np.zeros((PARTS, size // 8), dtype=np.uint8)
    for row in rows:
        whole[row["part"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return whole.reshape(-1), max((r["levels"] for r in rows), default=0)


def _entries(part: int, pairs: bytes, counts: bytes, least: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(pairs, dtype=np.uint32).astype(np.uint64) + np.uint64(part << REST_BITS)
    counts = np.frombuffer(counts, dtype=np.uint32)
    often = counts >= least
    return pairs[often], _levels(counts[often], least)


def _others(part: int, pairs: bytes, counts: bytes, least: int) -> tuple[np.ndarray, ...]:
    """The ids of bigrams that the filter does not hold, and their counts."""
    counts = np.frombuffer(counts, dtype=np.uint32)
    if part >= PARTS:
        return *np.frombuffer(pairs, dtype=np.int64).reshape(-1, 2).T.copy(), counts
    rare = counts < least
    pairs = np.frombuffer(pairs, dtype=np.uint32)[rare].astype(np.uint64) + np.uint64(part << REST_BITS)
    return *_sides(pairs), counts[rare]


def left_out(bigrams: DataFrame, least: int) -> DataFrame:
    """``h``, ``w`` and the discounted count ``kept`` of each bigram that the filter does not hold."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(3))):
                h, w, counts = _others(*row, least)
                levels = _levels(counts, TWICE)
                kept = _values(int(levels.max(initial=0)), TWICE)[levels] - DISCOUNT
                yield pa.RecordBatch.from_arrays([*map(pa.array, (h, w, kept))], ["h", "w", "kept"])

    return bigrams.mapInArrow(listed, "h long, w long, kept double")


def sieve(bigrams: DataFrame, least: int) -> np.ndarray:
    """Bits that all bigrams have that the filter does not hold, and few others."""
    size = SIEVE // (2 * PARTS)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(3))):
                h, w, _ = _others(*row, least)
                if not len(h):
                    continue
                bits, keys = np.zeros(size, dtype=bool), _keys(h, w)
                for probe in range(SIFTS):
                    bits[_sieve_bits(keys, probe)] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())],
                    ["part", "bits"],
                )

    whole = np.zeros((2 * PARTS, size // 8), dtype=np.uint8)
    for row in bigrams.mapInArrow(marked, "part long, bits binary").collect():
        whole[row["part"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return whole.reshape(-1)


def sifted(bits: np.ndarray, parts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the bigrams that the sieve lets through."""
    alive = np.arange(len(keys))
    for probe in range(SIFTS):
        at = parts[alive] * (SIEVE // (2 * PARTS)) + _sieve_bits(keys[alive], probe)
        alive = alive[(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
    return alive


def _kept_mass(bigrams: DataFrame, others: DataFrame, least: int, known: int) -> np.ndarray:
    """For each known history, the sum of its kept and discounted counts."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pairs, counts in zip(*(batch.column(c).to_pylist() for c in range(3))):
                pairs, levels = _entries(part, pairs, counts, least)
                mass = _values(int(levels.max(initial=0)), least)[levels] - DISCOUNT
                history, where = np.unique(_histories(pairs), return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(history, pa.int64()),
                        pa.array(np.bincount(where, mass, len(history)), pa.float64()),
                    ],
                    ["h", "kept"],
                )

    rows = bigrams.filter(F.col("part") < PARTS).mapInArrow(summed, "h long, kept double")
    rows = rows.unionByName(others.filter("h >= 0").select("h", "kept"))
    total = np.zeros(known)
    for row in rows.groupBy("h").agg(F.sum("kept").alias("kept")).collect():
        total[row["h"]] = row["kept"]
    return total


def gains(others: DataFrame, vocabulary: DataFrame, model: dict, total: float) -> DataFrame:
    """``key`` of each bigram outside the filter, and the ``gain`` of its word's score over back-off."""
    context = others.sparkSession.sparkContext
    shared = {name: context.broadcast(model[name]) for name in ("counts", "mass")}

    def gained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, mass = shared["counts"].value, shared["mass"].value

        def of(ids: np.ndarray, own: np.ndarray, column: pa.Array) -> np.ndarray:
            values = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            values[ids >= 0] = own[ids[ids >= 0]]
            return values

        for batch in batches:
            h, w, kept = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            n = of(h, counts, batch.column(3))
            backed = np.clip(1 - of(h, mass, batch.column(4)) / n, 1e-12, 1)
            backed *= (of(w, counts, batch.column(5)) + ADD) / total
            gain = np.log10(np.minimum(kept / n + backed, 1.0)) - np.log10(backed)
            keys = _keys(h.astype(np.int64), w.astype(np.int64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(gain)], ["key", "gain"])

    # known tokens, some of them in very many bigrams, match nothing here and are spread
    spread = F.xxhash64("h", "w").bitwiseAND(F.lit(SIGN - 1))
    sides = [F.when(F.col(c) < 0, F.col(c)).otherwise(spread).alias(f"{c}_id") for c in ("h", "w")]
    left = vocabulary.select(F.col("id").alias("h_id"), F.col("n").alias("h_n"), F.col("mass").alias("h_mass"))
    right = vocabulary.select(F.col("id").alias("w_id"), F.col("n").alias("w_n"))
    rows = others.select("*", *sides).join(left, "h_id", "left").join(right, "w_id", "left")
    return rows.select("h", "w", "kept", "h_n", "h_mass", "w_n").mapInArrow(gained, "key long, gain double")


def probed(bits: np.ndarray, pairs: np.ndarray, levels: int) -> np.ndarray:
    """The level of each pair, 0 if it is absent."""
    found = np.zeros(len(pairs), dtype=np.int64)
    alive = np.arange(len(pairs))
    offset = (pairs >> np.uint64(REST_BITS)).astype(np.int64) * (BITS // PARTS)
    for level in range(1, levels + 1):
        for probe in range(PROBES):
            at = offset[alive] + _positions(pairs[alive], level, probe)
            alive = alive[(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
        if not len(alive):
            break
        found[alive] = level
    return found


def _parts(docs: DataFrame, model: dict, total: float) -> DataFrame:
    """Each document's sums over known tokens, its other tokens with their numbers, and the keys of
    the bigrams that have to be looked up outside the filter."""
    context = docs.sparkSession.sparkContext
    shared = {name: context.broadcast(value) for name, value in model.items()}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {name: value.value for name, value in shared.items()}
        number = {token: n for n, token in enumerate(own["known"])}
        counts, mass, values = own["counts"], own["mass"], own["values"]
        probability = (counts + ADD) / total
        single = np.log10(probability)
        left = np.clip(1 - mass / counts, 1e-12, 1)
        row = TaskContext.get().partitionId() << 33

        def flush(ids, held, texts) -> pa.RecordBatch:
            nonlocal row
            words = [t for text in texts for t in text]
            numbers = _numbers(number, words)
            lengths = np.array([len(text) for text in texts])
            ends = np.cumsum(lengths)
            starts = ends - lengths
            history = np.concatenate([[0], numbers[:-1]])
            history[starts] = number.get(END, -1)
            known = numbers >= 0
            base = np.where(known, single[numbers], 0.0) if len(single) else np.zeros(len(numbers))
            score = base.copy()
            led = history >= 0
            score[led] += np.log10(left[history[led]])
            both = np.flatnonzero(led & known)
            level = probed(own["bits"], _pairs(history[both], numbers[both]), len(values) - 1)
            asked = ~(led & known)
            if own["rare"]:
                asked[both[level == 0]] = True
            keys, offsets = asked_for(words, numbers, history, np.flatnonzero(asked), starts, ends)
            both, level = both[level > 0], level[level > 0]
            h, w = history[both], numbers[both]
            p = (values[level] - DISCOUNT) / counts[h] + left[h] * probability[w]
            score[both] = np.log10(np.minimum(p, 1.0))
            rest = np.flatnonzero(~known)
            cuts = np.searchsorted(rest, np.concatenate([[0], ends]))
            rest = [_short(words[n]) for n in rest.tolist()]
            others = [Counter(rest[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            sums = [np.add.reduceat(x, starts) for x in (known.astype(np.int64), base, score)]
            columns = [
                pa.array(np.arange(row, row + len(texts))),
                pa.array(ids, pa.int64()),
                pa.array(held, pa.bool_()),
                pa.array(lengths.astype(np.int64)),
                *map(pa.array, sums),
                pa.array([list(o.keys()) for o in others], pa.list_(pa.binary())),
                pa.array([list(o.values()) for o in others], pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys)),
            ]
            row += len(texts)
            names = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "others", "times", "keys"]
            return pa.RecordBatch.from_arrays(columns, names)

        def asked_for(words, numbers, history, where, starts, ends) -> tuple[np.ndarray, np.ndarray]:
            ids = _ids(numbers, words)
            before = np.concatenate([[0], ids[:-1]])
            before[starts] = history[starts]
            keys = _keys(before[where], ids[where])
            parts = PARTS + (keys >> np.uint64(KEY_BITS)).astype(np.int64)
            of_known = (before[where] >= 0) & (ids[where] >= 0)
            pairs = _pairs(before[where][of_known], ids[where][of_known])
            parts[of_known] = (pairs >> np.uint64(REST_BITS)).astype(np.int64)
            found = sifted(own["sieve"], parts, keys)
            offsets = np.searchsorted(where[found], np.concatenate([[0], ends]))
            return keys[found].view(np.int64), offsets

        ids, held, texts, size = [], [], [], 0
        for batch in batches:
            for n in range(batch.num_rows):
                ids.append(batch.column(0)[n].as_py())
                held.append(batch.column(1)[n].as_py())
                texts.append(tokens(batch.column(2)[n].as_py()))
                size += len(texts[-1])
                if size >= BATCH:
                    yield flush(ids, held, texts)
                    ids, held, texts, size = [], [], [], 0
        if ids:
            yield flush(ids, held, texts)

    return docs.mapInArrow(
        scored,
        "row long, doc_id long, held_out boolean, n_tokens long, known long, base double,"
        " score double, others array<binary>, times array<long>, keys array<long>",
    )


def score(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities of the whole text)."""
    rows = _texts(docs)
    train = rows.filter(~F.col("held_out"))
    counts = settle(token_counts(train), "tokens")
    n, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    known, known_counts = _most_frequent(counts, KNOWN)
    bigrams = settle(bigram_counts(train, known), "bigrams")
    least = _least(bigrams)
    bits, levels = build(bigrams, least)
    total = n + ADD * (distinct + 1)
    outside = settle(left_out(bigrams, least), "outside")
    model = {
        "known": known,
        "counts": known_counts,
        "mass": _kept_mass(bigrams, outside, least, len(known)),
        "values": _values(levels, least),
        "bits": bits,
        "sieve": sieve(bigrams, least),
        "rare": least > TWICE,
    }
    mass = outside.filter("h < 0").groupBy(F.col("h").alias("id")).agg(F.sum("kept").alias("mass"))
    vocabulary = counts.withColumn("id", _id("token")).join(mass, "id", "left")
    vocabulary = settle(vocabulary.select("token", "id", "n", "mass"), "vocabulary")
    gained = gains(outside, vocabulary, model, total)
    parts = settle(_parts(rows, model, total), "scores")

    pair = F.explode(F.arrays_zip("others", "times")).alias("x")
    others = parts.select("row", pair).select("row", F.col("x.others").alias("token"), "x.times")
    seen = others.join(vocabulary, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # each other token is the history of one more token
    left = F.when(F.col("mass").isNull(), 1.0).otherwise(F.greatest(1 - F.col("mass") / F.col("n"), F.lit(1e-12)))
    seen = seen.select(
        "row",
        (F.col("times") * F.log10((F.col("n") + ADD) / total)).alias("other"),
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("seen"),
        (F.col("times") * F.log10(left)).alias("more"),
    )
    asked = parts.select("row", F.explode("keys").alias("key")).join(gained, "key")
    asked = asked.select("row", F.lit(0.0).alias("other"), F.lit(0).alias("seen"), F.col("gain").alias("more"))
    sums = seen.unionByName(asked).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("other", "seen", "more")))
    other = F.coalesce("other", F.lit(0.0))
    return parts.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + other).alias("base_score"),
        (F.col("score") + other + F.coalesce("more", F.lit(0.0))).alias("score"),
    )
