from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamis.llm import substring_dedup
from tamis.llm.substring_dedup import NOWHERE, WINDOW, Automaton
from tests.llm.frames import CLASHING, DOCS, documents, text_of


def _windows(words, size=WINDOW):
    return [tuple(words[n : n + size]) for n in range(len(words) - size + 1)]


def _brute(rows):
    """(id, words, words that go, kept text) of each row."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        if i is not None:
            for w in _windows(words):
                first[w] = min(i, first.get(w, i))
    out = []
    for i, words in split:
        gone = set()
        if i is not None:
            for n, w in enumerate(_windows(words)):
                if first[w] < i:
                    gone.update(range(n, n + WINDOW))
        kept = [w for n, w in enumerate(words) if n not in gone]
        out.append((i, len(words), len(gone), b" ".join(kept).decode()))
    return out


def _sorted(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def _got(spark, rows, parts=3):
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows]).repartition(parts)
    return _sorted(substring_dedup.cleaned(docs).collect())


words = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(words, st.integers(0, 5)), min_size=1, max_size=6), words, st.integers(1, 4))
def test_automaton_tells_where_each_window_is_first(texts, probe, size):
    automaton = Automaton([t for t, _ in texts], [i for _, i in texts], size)
    where = {}
    for text, i in texts:
        for w in _windows(text, size):
            where[w] = min(i, where.get(w, i))
    for text in [probe, *(t for t, _ in texts)]:
        assert automaton.firsts(text) == [where.get(w, NOWHERE) for w in _windows(text, size)]


def test_equal_windows_have_equal_keys():
    rng = random.Random(1)
    texts = [[rng.choice([b"x", b"y", b"zz\xff"]) for _ in range(n)] for n in (400, 0, 12, 13, 14, 150, 3)]
    spaces = [b" ", b"\n\t", b"  ", b"\x0b\x0c\r"]
    own = substring_dedup.Windows([rng.choice(spaces) + b"".join(w + rng.choice(spaces) for w in t) for t in texts])
    assert [own.joined[a:b] for a, b in zip(own.first, own.end)] == [w for t in texts for w in t]
    by_window = {}
    for words, start in zip(texts, own.starts.tolist()):
        for n, window in enumerate(_windows(words)):
            key = own.keys[start + n]
            assert by_window.setdefault(window, key) == key
            assert substring_dedup.Windows([b" ".join(window)]).keys.tolist() == [key]
    text, first, sizes = substring_dedup.runs(own.keys, own.starts)
    covered = [(t, w) for t, a, n in zip(text, first - own.starts[text], sizes) for w in range(a, a + n)]
    assert covered == [(t, w) for t, words in enumerate(texts) for w in range(len(_windows(words)))]
    assert all(len(set(own.keys[a : a + n])) == 1 for a, n in zip(first, sizes))
    assert len({*own.keys.tolist()}) > 50


def test_runs_are_short_and_texts_apart():
    own = substring_dedup.Windows([b"w " * 500, b"w " * 500])
    text, first, sizes = substring_dedup.runs(own.keys, own.starts)
    assert sizes.max() <= substring_dedup.RUN and sizes.sum() == 2 * (500 - WINDOW + 1)
    assert (np.diff(first)[text[1:] == text[:-1]] == sizes[:-1][text[1:] == text[:-1]]).all()
    for texts in ([], [b""], [b"w " * 12], [b"w " * 6, b"w " * 7], [b" \n"]):
        own = substring_dedup.Windows(texts)
        assert [len(x) for x in substring_dedup.runs(own.keys, own.starts)] == [0, 0, 0]


def _corpus():
    rng = random.Random(9)
    passages = [text_of(100 + n, 60) for n in range(4)]
    rows = []
    for i in range(120):
        parts = [text_of(i, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            own = rng.choice(passages).split()
            a = rng.randrange(40)
            parts += [" ".join(own[a : a + rng.randint(5, 40)]), text_of(1000 + i, rng.randint(0, 9))]
        rows.append((rng.randrange(1000), "  ".join(parts)))
    rows += [(2000 + n, rows[3][1]) for n in range(12)]  # copies
    rows += [(1500 + n, f"{text_of(n, 4)} {passages[0]} {text_of(50 + n, 4)}") for n in range(30)]
    rows += [(3000 + n, "again and " * (20 * n)) for n in range(4)]
    rows += [(3000, "again and " * 33), (2001, rows[3][1]), (None, passages[0])]
    return rows


@pytest.mark.parametrize("crowd,split,shard", [(4096, 20_000, 100_000), (3, 4, 300)])
def test_equals_brute_force(spark, monkeypatch, crowd, split, shard):
    for name, value in (("CROWD", crowd), ("SPLIT", split), ("SHARD", shard)):
        monkeypatch.setattr(substring_dedup, name, value)
    rows = _corpus()
    want = _sorted(_brute(rows))
    assert sum(r[2] for r in want) > 2000
    assert _got(spark, rows) == want


def test_full_bitmap_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BITS", 1 << 8)
    monkeypatch.setattr(substring_dedup, "SPANS", 0)  # spans are joined by a shuffle
    rows = _corpus()
    assert _got(spark, rows) == _sorted(_brute(rows))


def test_edge_cases(spark):
    rows = [(i, t) for i, t, _, _ in DOCS]
    assert _got(spark, rows) == _sorted(_brute(rows))
    docs = documents(spark, DOCS)
    assert substring_dedup.cleaned(docs.limit(0)).collect() == []
    more = docs.selectExpr("*", "1 AS name", "2 AS words", "3 AS start", "4 AS spans", "5 AS first", *CLASHING)
    assert _sorted(substring_dedup.cleaned(more).collect()) == _sorted(_brute(rows))
    digest = substring_dedup.digest(substring_dedup.cleaned(docs))
    assert digest.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_windows_must_be_whole(spark):
    own = text_of(5, 30).split()
    rows = [(1, " ".join(own)), (2, " ".join(own[:12])), (3, " ".join(own[:13])), (4, " ".join(own[4:16] + own[17:29]))]
    got = {r[0]: r[2] for r in _got(spark, rows)}
    assert got == {1: 0, 2: 0, 3: 13, 4: 0}
