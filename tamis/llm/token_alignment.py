"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes into tokens.  Where tokens of both end at the same byte, the
text falls into groups; the last tokens of a group are linked.  Most stretches are one-to-one:
there the end arrays are equal at a constant index shift.  Slices of doubling length are compared
at the current shift; a slice that differs is halved down to its first difference.  An irregular
group behind the stretch is resolved token by token, which gives the next shift.

Two narrow jobs do it, without a shuffle of texts: the first encodes and aligns each document and
writes its digest and links (four bytes each), the second looks the links up in the counts of all
documents.  Linked tokens end together, so the bytes of one end with those of the other: a token
has at most as many partners as its bytes have suffixes, which bounds the broadcast counts by the
length of both vocabularies whatever the corpus holds (:meth:`Coder.most_pairs`).

Defined cases: a text that is null or empty, or whose joined bytes in either tokenizer differ from
a space and the text (invalid UTF-8, characters that a tokenizer changes), has no tokens; ids are
kept as they are, null or repeated; repeated rows count as often as they occur; an empty table
gives an empty result; extra columns are ignored.  A document must fit in memory.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import settle

#: Texts that are encoded together, and bytes in them.
TEXTS, BYTES = 256, 8_000_000
#: Links that a task counts at once.
HELD = 8_000_000
#: What a pair's number multiplies the first tokenizer's id by.
SHIFT = 16

DIGEST = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
)

Group = tuple[int, int, int, int, bool]


def _stretch(a: list[int], b: list[int], i: int, j: int) -> int:
    """How many ends from ``a[i]`` and ``b[j]`` on are equal one by one."""
    if a[i] != b[j]:
        return 0
    run, step, n = 1, 2, len(a) - i
    while run < n:
        if a[i + run : i + run + step] == b[j + run : j + run + step]:
            run += step
            step *= 2
            continue
        low, high = 0, step  # the first difference is at low or later, below high
        while high - low > 1:
            half = (low + high) // 2
            if a[i + run + low : i + run + half] == b[j + run + low : j + run + half]:
                low = half
            else:
                high = half
        return run + low
    return n


def align(a: list[int], b: list[int]) -> list[Group]:
    """Groups between common ends of two increasing arrays with the same last end.

    (i, p, j, q, True) is a one-to-one stretch of the tokens ``i`` to ``p`` and ``j`` to ``q``;
    with False it is one group of all of these tokens.
    """
    found: list[Group] = []
    i = j = 0
    while i < len(a):
        if run := _stretch(a, b, i, j):
            found.append((i, i + run, j, j + run, True))
            i, j = i + run, j + run
            if i == len(a):
                break
        p, q = i, j
        end, other = a[p], b[q]
        while end != other:
            if end < other:
                p += 1
                end = a[p]
            else:
                q += 1
                other = b[q]
        found.append((i, p + 1, j, q + 1, False))
        i, j = p + 1, q + 1
    return found


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand for
    themselves, the others for the letters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in own]
    return {chr(c): byte for c, byte in [*zip(own, own), *((256 + n, byte) for n, byte in enumerate(others))]}


class Coder:
    """Both tokenizers, given by the paths of their vocabularies."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(byte_level, encoding="utf-8") as file:
            stored = json.load(file)
        model = stored["model"]
        letters = _letters()
        self.bytes_a = [b""] * (1 + max(model["vocab"].values()))
        for token, n in model["vocab"].items():
            if all(c in letters for c in token):
                self.bytes_a[n] = bytes(letters[c] for c in token)
        self._plain = Tokenizer.from_file(byte_level)
        self._plain.encode_special_tokens = True
        # ids that follow the merges are ranks, which a faster encoder takes
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [model["vocab"][x + y] for x, y in pairs]
        self._fast = None
        if all(x < y for x, y in zip(merged, merged[1:])):
            marks = {t["content"] for t in stored["added_tokens"]}
            ranks = {self.bytes_a[n]: n for t, n in model["vocab"].items() if t not in marks}
            self._fast = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_b = [self._piece(n) for n in range(self._pieces.get_piece_size())]
        self._sizes = [np.array([len(x) for x in side]) for side in (self.bytes_a, self.bytes_b)]
        self._names = [[str(n) for n in range(len(side))] for side in (self.bytes_a, self.bytes_b)]

    def _piece(self, n: int) -> bytes:
        piece = self._pieces.id_to_piece(n)
        if self._pieces.is_byte(n):
            return bytes([int(piece[3:5], 16)])
        if self._pieces.is_control(n) or self._pieces.is_unknown(n):
            return b""
        return piece.replace("▁", " ").encode()

    def most_pairs(self) -> int:
        """A bound of different linked pairs: one for each suffix of each token."""
        return int(sum(sizes.sum() for sizes in self._sizes))

    def _first(self, text: str) -> list[int]:
        if self._fast is not None:
            try:
                return self._fast.encode_ordinary(text)
            except BaseException as error:  # the encoder gives up on some very long runs
                if type(error).__name__ != "PanicException":
                    raise
        return self._plain.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[bytes | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of each text in both tokenizers; none if either doesn't keep its bytes."""
        read = [(text or b"").decode("utf-8", "replace") for text in texts]
        others = self._pieces.encode(read, num_threads=1)
        found = []
        for raw, text, b in zip(texts, read, others):
            a = self._first(" " + text) if raw else []
            whole = b" " + (raw or b"")
            kept = raw and all(
                b"".join([side[n] for n in ids]) == whole
                for side, ids in ((self.bytes_a, a), (self.bytes_b, b))
            )
            found.append((a, b) if kept else ([], []))
        return found

    def ends(self, a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
        return tuple(np.cumsum(size[ids]).tolist() for size, ids in zip(self._sizes, (a, b)))

    def digest(self, a: list[int], b: list[int]) -> tuple[int, str, bytes]:
        """Number of groups, hash of their text, and links of a document."""
        if not a:
            return 0, "", b""
        first, second = self._names
        parts, linked_a, linked_b = [], [], []
        for i, p, j, q, one in align(*self.ends(a, b)):
            if one:
                linked_a += a[i:p]
                linked_b += b[j:q]
                parts += [f"{first[x]}|{second[y]}" for x, y in zip(a[i:p], b[j:q])]
            else:
                linked_a.append(a[p - 1])
                linked_b.append(b[q - 1])
                parts.append(
                    ",".join([first[x] for x in a[i:p]]) + "|" + ",".join([second[y] for y in b[j:q]])
                )
        links = (np.array(linked_a, dtype=np.uint32) << SHIFT) | np.array(linked_b, dtype=np.uint32)
        text = hashlib.sha256(";".join(parts).encode()).hexdigest()
        return len(parts), text, links.astype("<u4").tobytes()


def _coder(byte_level: str, pieces: str) -> Coder:
    """The process's own: loading vocabularies takes longer than a small task."""
    import tokenizers

    coders = vars(tokenizers).setdefault("_aligned", {})  # code sent to tasks has no module
    if (byte_level, pieces) not in coders:
        coders[byte_level, pieces] = Coder(byte_level, pieces)
    return coders[byte_level, pieces]


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row per document, see ``DIGEST``; ``links`` are 32-bit numbers, the first tokenizer's id
    in their high half."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(byte_level, pieces)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size = [], 0
                while at + len(texts) < batch.num_rows and len(texts) < TEXTS and size < BYTES:
                    texts.append(batch.column(1)[at + len(texts)].as_py())
                    size += len(texts[-1] or b"")
                ids = coder.encode(texts)
                n_groups, hashes, links = zip(*(coder.digest(a, b) for a, b in ids))
                counts = [[len(a) for a, _ in ids], [len(b) for _, b in ids], n_groups, [len(x) // 4 for x in links]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(hashes, pa.string()),
                        pa.array(links, pa.binary()),
                    ],
                    [field.split()[0] for field in DIGEST.split(", ")],
                )
                at += len(texts)

    text = F.col("text").cast("string").cast("binary").alias("text")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(rows, DIGEST)


def pair_counts(digests: DataFrame) -> DataFrame:
    """``pair`` and ``n``, its links in all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

        def merged(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            own, n = np.unique(np.concatenate(held), return_counts=True)
            both, place = np.unique(np.concatenate([pairs, own]), return_inverse=True)
            return both, np.bincount(place, np.concatenate([counts, n]), len(both)).astype(np.int64)

        held, size = [pairs], 0
        for batch in batches:
            for links in batch.column(0):
                held.append(np.frombuffer(links.as_buffer(), dtype="<u4"))
                size += len(held[-1])
                if size > HELD:
                    pairs, counts = merged(held)
                    held, size = [pairs[:0]], 0
        pairs, counts = merged(held)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(counts)], ["pair", "n"])

    found = digests.select("links").mapInArrow(counted, "pair long, n long")
    return found.groupBy("pair").agg(F.sum("n").alias("n"))


def scored(digests: DataFrame, counts: DataFrame) -> DataFrame:
    """The digests with ``n_best`` and ``count_sum`` of their links."""
    table = counts.orderBy("pair").toArrow()
    pairs, n = (table.column(c).to_numpy() for c in ("pair", "n"))
    second = pairs & ((1 << SHIFT) - 1)
    highest = np.zeros(1 << SHIFT, dtype=np.int64)
    np.maximum.at(highest, second, n)
    shared = digests.sparkSession.sparkContext.broadcast((pairs.astype(np.uint32), n, n == highest[second]))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = shared.value
        for batch in batches:
            links = [np.frombuffer(x.as_buffer(), dtype="<u4") for x in batch.column("links")]
            sums = []
            for own in links:
                at = np.searchsorted(pairs, own)
                sums.append((int(best[at].sum()), int(n[at].sum())) if len(at) else (0, 0))
            n_best, count_sum = zip(*sums) if sums else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                [*batch.schema.names[:-1], "n_best", "count_sum"],
            )

    return digests.mapInArrow(looked_up, DIGEST.replace("links binary", "n_best long, count_sum long"))


def summary(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row per document: its tokens, groups and links, and how common its links are."""
    digests = settle(aligned(docs, byte_level, pieces), "aligned")
    return scored(digests, settle(pair_counts(digests), "pairs"))
