"""Hierarchical packing of documents into sequences of several lengths.

A document's full windows of the longest tier are sequences of their own.  What is left is routed
to the shortest tier that holds it.  Each tier is packed from its longest piece on; gaps are
filled with the longest whole pieces of shorter tiers that fit, and the last gap of a sequence
with the head of a longer piece, so that every sequence is exactly as long as its tier.  The
rest of a block, less than one sequence, goes down the powers of two.  The sequences of a block
are then dealt to step groups of about equal work.

Packing needs no shuffle: each task tokenizes and packs its own rows, in blocks of a bounded
number of tokens.  A task that runs again packs the same rows in the same way, so sequence ids
(task, running number) stay the same.

Defined cases: a null text is an empty one; an empty text is its end token alone; a null id is
kept; repeated rows are packed as often as they occur; an empty table gives an empty result;
extra columns are ignored.  One document must fit in memory, a block takes ``BLOCK`` tokens more.
"""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (2048, 1024, 512, 256)
END_ID = 1
#: Tokens that are packed together, and those of a training step.
BLOCK, STEP = 4_000_000, 65_536
#: Words whose ids a process keeps, and bytes in these words.
CACHE, CACHE_BYTES = 1_600_000, 64_000_000
MARKS = b".,!?;:#*$%&|"
#: Letters below are in composed form.
PLAIN_END = "\u0180"

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long, tier int, step_group long"
)


class WordIds:
    """The ids of texts, word by word.

    The tokenizer splits at white space before it does anything else that looks at neighbours,
    so the ids of a text are those of its words; each word is encoded once per process.  Words of
    letters need neither normalizing nor splitting once they are in lower case: many are encoded
    as one string, and each ends with its only token that ends a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        self._plain = Tokenizer.from_file(path)
        self._plain.normalizer = normalizers.Sequence([])
        self._plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.CharDelimiterSplit(" "),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self._whole.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._known: dict[bytes, bytes] = {}
        self._parts: dict[bytes, bytes] = {b"": b""}
        self._held = 0

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known, parts = self._known, self._parts
        if len(known) > CACHE or self._held > CACHE_BYTES:
            known.clear()
            parts.clear()
            parts[b""] = b""
            self._held = 0
        split = [text.split() for text in texts]
        fresh = {word: _parts(word) for word in set().union(*split).difference(known)}
        self._encode_plain([*{letters for letters, _ in fresh.values()}.difference(parts)])
        others = [*{marks for _, marks in fresh.values()}.difference(parts)]
        codes = self._whole.encode_batch([x.decode("utf-8", "replace") for x in others], add_special_tokens=False)
        for part, code in zip(others, codes):
            parts[part] = array("I", code.ids).tobytes()
        for word, (letters, marks) in fresh.items():
            known[word] = parts[letters] + parts[marks]
        self._held += sum(map(len, fresh))
        return [b"".join(map(known.__getitem__, text)) for text in split]

    def _encode_plain(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            code = self._plain.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0]
            ids = np.array(code.ids, dtype="<u4")
            raw, start = ids.tobytes(), 0
            for word, end in zip(some, (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()):
                self._parts[word] = raw[start:end]
                start = end


def _coder(path: str) -> WordIds:
    """The process's own: its tasks go on with the words that earlier ones have encoded."""
    import tokenizers

    coders = vars(tokenizers).setdefault("_word_ids", {})  # code sent to tasks has no module
    if path not in coders:
        coders[path] = WordIds(path)
    return coders[path]


def _parts(word: bytes) -> tuple[bytes, bytes]:
    """What a word is encoded as: letters in lower case, and the marks behind them.

    The tokenizer does both itself; so fewer different strings are encoded.  Any other word has
    no such letters and is left as it is.
    """
    letters = word.rstrip(MARKS)
    if letters.isalpha():  # ASCII letters
        return letters.lower(), word[len(letters) :]
    if not letters.isascii():
        lower = letters.decode("utf-8", "replace").lower()
        if lower.isalpha() and max(lower) < PLAIN_END:
            return lower.encode(), word[len(letters) :]
    return b"", word


class Block:
    """The pieces of some documents, packed.  A piece is (document, start, length)."""

    def __init__(self, lengths: list[int], tiers: tuple[int, ...]):
        self.sequences: list[tuple[int, list[tuple[int, int, int]]]] = []
        self._stacks: list[list[tuple[int, int]]] = [[] for _ in range(tiers[0] + 1)]
        self._present = 0  # bit n: there is a piece of length n
        longest = tiers[0]
        for doc, length in enumerate(lengths):
            full = length - length % longest
            for start in range(0, full, longest):
                self.sequences.append((longest, [(doc, start, longest)]))
            if length > full:
                self._put(doc, full, length - full)
        while self._present:
            longest_piece = self._present.bit_length() - 1
            self._fill(min(tier for tier in tiers if tier >= longest_piece))

    def _put(self, doc: int, start: int, length: int) -> None:
        self._stacks[length].append((doc, start))
        self._present |= 1 << length

    def _take(self, most: int) -> tuple[int, int, int] | None:
        """The longest piece of at most ``most`` tokens."""
        length = (self._present & ((1 << (most + 1)) - 1)).bit_length() - 1
        if length < 1:
            return None
        doc, start = self._stacks[length].pop()
        if not self._stacks[length]:
            self._present &= ~(1 << length)
        return doc, start, length

    def _fill(self, tier: int) -> None:
        pieces, gap = [], tier
        while gap and (piece := self._take(gap)):
            pieces.append(piece)
            gap -= piece[2]
        if gap and (piece := self._take(tier)):
            doc, start, length = piece
            pieces.append((doc, start, gap))
            self._put(doc, start + gap, length - gap)
            gap = 0
        if gap:
            self._descend(pieces, tier - gap)
        else:
            self.sequences.append((tier, pieces))

    def _descend(self, pieces: list[tuple[int, int, int]], total: int) -> None:
        """Cut the last, open sequence into sequences of powers of two."""
        pieces = pieces[::-1]
        while total:
            size = room = 1 << (total.bit_length() - 1)
            total -= size
            own = []
            while room:
                doc, start, length = pieces.pop()
                own.append((doc, start, min(length, room)))
                if length > room:
                    pieces.append((doc, start + room, length - room))
                room -= own[-1][2]
            self.sequences.append((size, own))

    def steps(self, step: int) -> list[int]:
        """The step group of each sequence: the longest first, each to the lightest group."""
        tokens = sum(size for size, _ in self.sequences)
        groups = [(0, n) for n in range(max(1, -(-tokens // step)))]
        step_of = [0] * len(self.sequences)
        for n in sorted(range(len(step_of)), key=lambda n: -self.sequences[n][0]):
            load, step_of[n] = heapq.heappop(groups)
            heapq.heappush(groups, (load + self.sequences[n][0], step_of[n]))
        return step_of


def _rows(
    ids: list, tokens: list[bytes], tiers: tuple[int, ...], first: int
) -> tuple[pa.RecordBatch, int]:
    block = Block([len(t) // 4 for t in tokens], tiers)
    columns: list[list] = [[] for _ in range(9)]
    for n, ((size, pieces), step) in enumerate(zip(block.sequences, block.steps(STEP))):
        offset = 0
        for doc, start, length in pieces:
            crc = zlib.crc32(memoryview(tokens[doc])[4 * start : 4 * (start + length)])
            row = (ids[doc], start, length, crc, len(tokens[doc]) // 4, first + n, offset, size, first + step)
            for column, value in zip(columns, row):
                column.append(value)
            offset += length
    types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
    names = [field.split()[0] for field in SCHEMA.split(",")]
    arrays = [pa.array(c, t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names), len(block.sequences)


def pack(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece of a document, see ``SCHEMA``; ``tokenizer`` is the vocabulary's path."""
    end = END_ID.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        place = TaskContext.get().partitionId() << 32
        ids, tokens, held = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids += part.column(0).to_pylist()
                tokens += [t + end for t in coder.of(part.column(1).to_pylist())]
                held += sum(len(t) for t in tokens[-part.num_rows :]) // 4
                if held >= BLOCK:
                    rows, n = _rows(ids, tokens, tiers, place)
                    yield rows
                    place, ids, tokens, held = place + n, [], [], 0
        if ids:
            yield _rows(ids, tokens, tiers, place)[0]

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(packed, SCHEMA)
