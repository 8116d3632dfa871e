from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tamis.llm import token_alignment
from tamis.llm.queries import QUERIES
from tests.llm.frames import CLASHING, DOCS, documents, text_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATHS = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def coder():
    return token_alignment.Coder(*PATHS)


def _plain_groups(a, b):
    common = sorted(set(a) & set(b))
    groups, i, j = [], 0, 0
    for end in common:
        p, q = a.index(end) + 1, b.index(end) + 1
        groups.append((i, p, j, q))
        i, j = p, q
    return groups


def _single(groups):
    out = []
    for i, p, j, q, one in groups:
        if one:
            assert p - i == q - j
            out += [(i + n, i + n + 1, j + n, j + n + 1) for n in range(p - i)]
        else:
            out.append((i, p, j, q))
    return out


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.lists(st.integers(1, 60), max_size=40))
def test_groups_lie_between_common_ends(first, second, shared):
    last = max([61, *first, *second])
    a, b = (sorted({*side, *shared, last}) for side in (first, second))
    assert _single(token_alignment.align(a, b)) == _plain_groups(a, b)


def test_long_stretches_are_skipped_whole():
    a = list(range(1, 5001))
    assert token_alignment.align(a, a) == [(0, 5000, 0, 5000, True)]
    b = [x for x in a if x != 2500]
    assert [g[4] for g in token_alignment.align(a, b)] == [True, False, True]


def _brute(rows):
    """Digest columns by the plain libraries, sets of ends and counters."""
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = {v: k for k, v in _byte_letters().items()}

    def piece(n):
        text = second.id_to_piece(n)
        return bytes([int(text[3:5], 16)]) if second.is_byte(n) else text.replace("▁", " ").encode()

    docs = []
    for _, text in rows:
        if not text:
            docs.append(None)
            continue
        a = first.encode(" " + text, add_special_tokens=False)
        b = second.encode(text)
        sides = [[bytes(letters[c] for c in t) for t in a.tokens], [piece(n) for n in b]]
        if any(b"".join(side) != (" " + text).encode() for side in sides):
            docs.append(None)
            continue
        ends = []
        for side in sides:
            total, own = 0, []
            for token in side:
                total += len(token)
                own.append(total)
            ends.append(own)
        docs.append((a.ids, b, _plain_groups(*ends)))
    counts = Counter((d[0][p - 1], d[1][q - 1]) for d in docs if d for _, p, _, q in d[2])
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for (i, _), d in zip(rows, docs):
        if d is None:
            out.append((i, 0, 0, 0, 0, "", 0, 0))
            continue
        a, b, groups = d
        links = [(a[p - 1], b[q - 1]) for _, p, _, q in groups]
        text = ";".join(
            ",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])) for i, p, j, q in groups
        )
        best = sum(counts[x] == highest[x[1]] for x in links)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((i, len(a), len(b), len(groups), len(links), digest, best, sum(counts[x] for x in links)))
    return out


def _byte_letters():
    """The published rule: bytes that print stand for themselves, others for letters from 256."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    out, n = {}, 0
    for byte in range(256):
        if byte in shown:
            out[byte] = chr(byte)
        else:
            out[byte] = chr(256 + n)
            n += 1
    return out


TEXTS = [
    "a", " ", "  two  spaces ", "\n\n\ttabs", "<|endoftext|> <s> </s> <0x41>", "▁x ▁", "日本語 텍스트 ñandú",
    "x" * 5000, "é​﻿", "1234567890 3.14159", "\U0001f600\U0001f680 ok", "I'll don't we've",
]


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_summary_equals_the_plain_version(spark):
    rng = random.Random(7)
    rows = [(n, t) for n, t in enumerate(TEXTS)]
    rows += [(100 + n, text_of(n, rng.randint(1, 200))) for n in range(60)]
    rows += [(200, "the same text twice"), (200, "the same text twice"), (None, "no id")]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])
    got = token_alignment.summary(docs.repartition(3), *PATHS)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    want = _brute(rows)
    assert sum(w[1] == 0 for w in want) < 3  # the plain version keeps nearly all of them
    assert _sorted(map(tuple, got.collect())) == _sorted(want)


def test_query_equals_the_plain_version(spark):
    """The registered query over the whole table."""
    rows = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = QUERIES["op12_token_alignment"](spark, SF_DIR).collect()
    assert _sorted(map(tuple, got)) == _sorted(_brute([(r["doc_id"], r["text"]) for r in rows]))


def test_edge_cases(spark):
    docs = documents(spark, DOCS)
    want = _brute([(i, t) for i, t, _, _ in DOCS])
    assert _sorted(map(tuple, token_alignment.summary(docs, *PATHS).collect())) == _sorted(want)
    assert token_alignment.summary(docs.limit(0), *PATHS).count() == 0
    more = docs.selectExpr("*", "1 AS n_a", "2 AS links", "3 AS pair", *CLASHING)
    assert _sorted(map(tuple, token_alignment.summary(more, *PATHS).collect())) == _sorted(want)
    broken = spark.range(1).selectExpr("id AS doc_id", "CAST(X'61FF62' AS STRING) AS text")
    assert tuple(token_alignment.summary(broken, *PATHS).first())[1:6] == (0, 0, 0, 0, "")


def test_fast_encoder_gives_the_ids_of_the_vocabulary(coder):
    assert coder._fast is not None
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000), 10, 32])) for _ in range(60))
        assert coder._fast.encode_ordinary(text) == coder._plain.encode(text, add_special_tokens=False).ids


def test_pairs_are_bounded_by_the_vocabularies(coder):
    ends = [x for x in coder.bytes_a if x]
    assert coder.most_pairs() >= len(ends) and coder.most_pairs() < 1_000_000
