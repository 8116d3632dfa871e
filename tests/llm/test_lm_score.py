from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tamis.llm import lm_score as lm
from tests.llm.frames import CLASHING, DOCS, documents


def _held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def _corpus(spark, count=200):
    rng = random.Random(6)
    words = ["the", "of", "cat", "dog", "RAN", "sat", "x", "É", "1", "."] + [f"w{i}" for i in range(30)]
    texts = {i: " ".join(rng.choice(words[: 3 + i % 37]) for _ in range(rng.randint(0, 60))) for i in range(count)}
    texts |= {i: "the cat sat on the mat " * 3 + f"r{i}" for i in range(count, count + 40)}
    return texts, documents(spark, [(i, t, "en", "s") for i, t in texts.items()])


def _brute(texts):
    tokens = {i: [*(t or "").encode().lower().split(), b""] for i, t in texts.items()}
    counts, pairs = Counter(), Counter()
    for i, own in tokens.items():
        if not _held(i):
            counts.update(own)
            pairs.update(zip([b"", *own], own))
    total = sum(counts.values()) + 0.1 * (len(counts) + 1)
    # quantised counts of what occurs twice or more
    levels = {p: 2 * lm.BASE ** math.floor(math.log(n / 2) / math.log(lm.BASE) + 1e-9) for p, n in pairs.items() if n > 1}
    kept = {p: math.ceil(v - 1e-9) - lm.DISCOUNT for p, v in levels.items()}
    mass = Counter()
    for (h, _), value in kept.items():
        mass[h] += value
    single = lambda w: (counts[w] + 0.1) / total

    def model(h, w):
        if not counts[h]:
            return single(w)
        return (kept.get((h, w), 0) + (counts[h] - mass[h]) * single(w)) / counts[h]

    return {
        i: (
            len(own),
            sum(counts[w] > 0 for w in own),
            sum(counts.values()),
            sum(math.log10(single(w)) for w in own),
            sum(math.log10(model(h, w)) for h, w in zip([b"", *own], own)),
        )
        for i, own in tokens.items()
    }


@pytest.mark.parametrize("most", [lm.KNOWN, 12])
def test_scores(spark, monkeypatch, most):
    texts, docs = _corpus(spark)
    want = _brute(texts)
    if most < lm.KNOWN:  # then only the most frequent tokens are known in the tasks
        frequent = lm._most_frequent
        monkeypatch.setattr(lm, "_most_frequent", lambda counts, _: frequent(counts, most))
    close = 0
    for r in lm.score(docs).collect():
        n, known, train, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, train, _held(r.doc_id))
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        close += math.isclose(r.score, score, rel_tol=1e-6)
    if most == lm.KNOWN:  # the filter may take an absent bigram for a present one
        assert close >= 0.98 * len(texts)


@pytest.mark.parametrize("most, least", [(12, 2), (lm.KNOWN, 5), (12, 5), (1, 2)])
def test_bigrams_outside_the_filter_count(spark, monkeypatch, most, least):
    texts, docs = _corpus(spark)
    want = _brute(texts)
    frequent = lm._most_frequent
    monkeypatch.setattr(lm, "_most_frequent", lambda counts, _: frequent(counts, most))
    monkeypatch.setattr(lm, "_least", lambda _: least)
    got = {r.doc_id: r.score for r in lm.score(docs).collect()}
    assert got.keys() == want.keys()
    assert sum(math.isclose(got[i], want[i][4], rel_tol=1e-6) for i in want) >= 0.98 * len(want)


@pytest.mark.parametrize("most", [lm.KNOWN, 5])
def test_long_tokens_are_sent_shortened(spark, monkeypatch, most):
    long = ["x" * 5000 + str(n) for n in range(4)]
    texts = {i: " ".join([long[i % 4], "a", long[i % 3], "b " * (i % 5)]) for i in range(60)}
    docs = documents(spark, [(i, t, "en", "s") for i, t in texts.items()])
    sent, frequent = [], lm._most_frequent

    def observed(counts, _):
        sent.append(frequent(counts, most))
        return sent[-1]

    monkeypatch.setattr(lm, "_most_frequent", observed)
    want = _brute(texts)
    got = lm.score(docs).collect()
    assert max(map(len, sent[0][0])) <= lm.LONG + 1
    assert {r.doc_id: r.n_known for r in got} == {i: w[1] for i, w in want.items()}
    assert all(math.isclose(r.base_score, want[r.doc_id][3], rel_tol=1e-9) for r in got)
    assert sum(math.isclose(r.score, want[r.doc_id][4], rel_tol=1e-6) for r in got) >= 0.98 * len(got)


def test_the_model_beats_its_base_on_held_out_texts(spark):
    _, docs = _corpus(spark, 400)
    held = [r for r in lm.score(docs).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_filter_gives_back_the_levels(spark):
    rng = np.random.default_rng(3)
    known = [b"", *(b"%d" % i for i in range(300))]
    texts = [" ".join(str(x) for x in rng.zipf(1.3, 60) % 300) for _ in range(300)]
    train = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]).selectExpr("binary(text) AS text")
    bigrams = lm.bigram_counts(train, known)
    least = lm._least(bigrams)
    bits, levels = lm.build(bigrams, least)
    pairs = Counter()
    for t in texts:
        own = [0, *(int(x) + 1 for x in t.split()), 0]
        pairs.update(zip(own, own[1:]))
    history, word = (np.array(side) for side in zip(*pairs))
    counts = np.array(list(pairs.values()))
    got = lm.probed(bits, lm._pairs(history, word), levels)
    often = counts >= least
    assert (got[often] >= lm._levels(counts[often], least)).all()  # never too low
    assert (got[often] == lm._levels(counts[often], least)).mean() > 0.98
    assert (got[~often] == 0).mean() > 0.98
    assert (lm._histories(lm._pairs(history, word)) == history).all()


def test_small_filters_keep_the_frequent_bigrams(spark, monkeypatch):
    texts, docs = _corpus(spark)
    train = docs.selectExpr("binary(text) AS text")
    known = sorted({w for t in texts.values() for w in t.encode().lower().split()} | {b""})
    bigrams = lm.bigram_counts(train, known).persist()
    monkeypatch.setattr(lm, "BITS", 1 << 13)
    least = lm._least(bigrams)
    assert least > 2
    kept = [lm._entries(*r, least) for r in bigrams.collect()]
    assert sum(levels.sum() for _, levels in kept) * lm.ROOM <= lm.BITS
    bigrams.unpersist()


def test_edge_cases(spark):
    assert lm.score(documents(spark, [])).count() == 0
    rows = documents(spark, DOCS)
    assert lm.score(rows).count() == len(DOCS)
    assert lm.score(rows.selectExpr("*", *CLASHING, "1 AS row", "'t' AS token")).count() == len(DOCS)
    held = next(i for i in range(100) if _held(i))
    r = lm.score(documents(spark, [(held, "a b", "en", "s")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
