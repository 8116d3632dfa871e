from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from tamis.llm import packing
from tests.llm.frames import CLASHING, DOCS, documents, text_of

PATH = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def _ids(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, packing.END_ID], dtype="<u4")


def _check(rows, docs, tokenizer):
    """Every id in one piece, hashes right, sequences gapless and of tier or power-of-two length."""
    ids = {i: _ids(tokenizer, text) for i, text in docs.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
    assert pieces.keys() == ids.keys()
    for i, own in pieces.items():
        end = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == end and r.length > 0
            end += r.length
        assert end == len(ids[i])
    for own in sequences.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end == own[0].tier <= 2048 and end & (end - 1) == 0


def test_words_are_encoded_as_texts_are(tokenizer):
    rng = random.Random(3)
    signs = "abzABZ éÉÈçßŒœÿŸİıſKÅǅ.,!?;:#'´$%&|<>0123¼²ªº́  \x85\x1c\t\n-_\U0001f600ΣσςКк中"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["don't I'll <|endoftext|>x <|EndOfText|>", "", " \n", "İ.", "x" * 5000]
    coder = packing.WordIds(PATH)
    for _ in range(2):  # the second time from what is known
        got = coder.of([t.encode() for t in texts])
        for text, own in zip(texts, got):
            want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
            assert own == want.tobytes(), text


def test_round_trip(spark, tokenizer):
    rng = random.Random(1)
    docs = {i: text_of(i, rng.choice([0, 1, 5, 60, 300, 1500])) for i in range(150)}
    docs |= {200: None, 201: "", 202: text_of(9, 9000)}
    frame = documents(spark, [(i, t, "en", "s") for i, t in docs.items()]).repartition(3)
    _check(packing.pack(frame, PATH).collect(), docs, tokenizer)


def test_blocks_are_packed_on_their_own():
    rng = random.Random(2)
    for lengths in ([1], [2048], [2049, 3], [rng.randint(1, 5000) for _ in range(400)]):
        block = packing.Block(lengths, packing.TIERS)
        assert sum(size for size, _ in block.sequences) == sum(lengths)
        assert all(sum(p[2] for p in pieces) == size for size, pieces in block.sequences)
        # a sequence cuts one piece at most
        assert sum(len(p) for _, p in block.sequences) <= 2 * (len(lengths) + len(block.sequences))
        steps = block.steps(4096)
        loads = defaultdict(int)
        for (size, _), step in zip(block.sequences, steps):
            loads[step] += size
        assert max(loads.values()) - min(loads.values()) <= 2048


def test_edge_cases(spark, tokenizer):
    assert packing.pack(documents(spark, []), PATH).count() == 0
    rows = documents(spark, DOCS)
    assert packing.pack(rows, PATH).count() >= len(DOCS)
    assert packing.pack(rows.selectExpr("*", *CLASHING), PATH).columns[0] == "doc_id"
    ends = packing.pack(documents(spark, [(1, None, "en", "s"), (2, "", "en", "s")]), PATH).collect()
    assert [r.doc_tokens for r in ends] == [1, 1]
