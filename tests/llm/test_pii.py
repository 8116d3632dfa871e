from __future__ import annotations

import hashlib
import random
import re

import pytest

from tamis.llm import pii
from tests.llm.frames import CLASHING, DOCS, documents, text_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def _valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in match.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and _luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def _base(text):
    found = [
        (m.start(), k, m.end())
        for k, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text)
        if _valid(kind, m[0])
    ]
    return sorted(found)


def _text(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _samples():
    rng = random.Random(4)
    fixed = [
        "",
        "mail a@b.c_d@e.f or x.y@z-1.co.uk. a@b, @b.c, a@b..c %+-@x.y",
        "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 1.2.3 00.0.0.0",
        "4111 1111 1111 1111, 4111-1111-1111-1112 4111  111111111111",
        "+1 (555) 123-4567. +1234567890123456 +12 +1-2-3-4-5-6-7-8-9-0) +1 x",
        "é\U0001f600中 a@b.cd \U0001f600 4111111111111111",
    ]
    signs = "0123456789.@+- ()ab%\U0001f600"
    return fixed + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(600)]


def test_base_spans(spark):
    texts = _samples()
    frame = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    for r in pii.digest(pii.spans(frame)).collect():
        want = _base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(_text(want).encode()).hexdigest()
        counts = (r.n_email, r.n_ip, r.n_card, r.n_phone)
        assert counts == tuple(sum(k == kind for _, k, _ in want) for kind in range(4))
        assert set(_text(want).split(",")) <= set(r.spans.split(",")) or not want
        order = [(int(a), pii.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert order == sorted(set(order))


def test_long_texts(spark):
    many = " ".join(f"user{i}@host{i}.org" for i in range(2000))
    digits = "1 " * 60_000 + "4111111111111111 " + "9" * 50_000
    frame = documents(spark, [(1, many, "en", "s"), (2, digits, "en", "s"), (3, "a" * 300_000 + "@", "en", "s")])
    got = {r.doc_id: r for r in pii.digest(pii.spans(frame)).collect()}
    assert got[1].n_email == 2000
    assert got[1].base_sha256 == hashlib.sha256(_text(_base(many)).encode()).hexdigest()
    assert got[2].base_sha256 == hashlib.sha256(_text(_base(digits)).encode()).hexdigest()
    assert got[3].spans == ""


def _planted(spark, count=300):
    """Card-like numbers; a tenth of those after "card" fail their check digit."""
    rows, rng = [], random.Random(8)
    for i in range(count):
        body = "".join(rng.choice("0123456789") for _ in range(15))
        good = next(d for d in "0123456789" if _luhn(body + d))
        check = good if i % 10 else str((int(good) + 1) % 10)
        number = body + check
        rows.append((i, f"{text_of(i, 5)} my card {number} {text_of(i + 1, 4)}", "en", "s"))
        rows.append((count + i, f"{text_of(i, 4)} part #{''.join(rng.choice('0123456789') for _ in range(17))}x", "en", "s"))
    return documents(spark, rows)


def test_trees_add_what_looks_like_a_base_span(spark):
    frame = _planted(spark)
    trees = pii.fit(pii.cells(frame), precision=0.8)
    assert pii.KINDS.index("card") in trees.thresholds
    got = {r.doc_id: r for r in pii.digest(pii.spans(frame, trees)).collect()}
    missed = [r for i, r in got.items() if i < 300 and not r.n_card]
    assert missed and all("card:" in r.spans for r in missed)
    assert not any(r.spans for i, r in got.items() if i >= 300 and not r.n_card)


def test_trees_score_as_their_case_expressions(spark):
    frame = _planted(spark)
    counts = pii.cells(frame)
    trees = pii.fit(counts)
    from pyspark.sql import functions as F

    rows = counts.select(*pii.BINS, trees.score(F.struct(*pii.BINS)).alias("score")).collect()
    import numpy as np

    x = np.array([tuple(r)[:-1] for r in rows])
    want = sum(pii._values(tree, x) for tree in trees.trees)
    assert np.allclose([r.score for r in rows], want)


def test_redaction(spark):
    texts = ["write a@b.cd or 1.2.3.4!", "none", None, "+1 555 123 4567 8.8.8.8", "\U0001f600 a@b.cd"]
    frame = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    none = pii.Trees((), {})
    got = {r.doc_id: r.text for r in pii.redact(frame, none).collect()}
    assert got[0] == "write <email> or <ip>!" and got[1] == "none" and got[2] is None
    # the phone's span runs into the address, so both are one
    assert got[3] == "<phone>" and got[4] == "\U0001f600 <email>"


@pytest.mark.parametrize("operator", [pii.spans, pii.redact])
def test_edge_cases(spark, operator):
    assert operator(documents(spark, [])).count() == 0
    rows = documents(spark, DOCS)
    assert operator(rows).count() == len(DOCS)
    more = rows.selectExpr("*", *CLASHING, "'b' AS base", "1 AS half")
    assert operator(more).count() == len(DOCS)
    assert pii.redact(more).columns == more.columns


def _numbers(spark, count=200):
    """International numbers, a few national ones after a cue, and digits that are no numbers."""
    rows, rng = [], random.Random(11)
    some = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    for i in range(count):
        rows.append((i, f"{text_of(i, 5)} +1 ({some(3)}) 555-{some(4)} {text_of(i + 1, 4)}"))
        rows.append((1000 + i, f"{text_of(i, 4)} {some(rng.choice([4, 5, 6, 8]))} {text_of(i, 3)} 20{some(2)}-{some(2)}-{some(2)}"))
        rows.append((2000 + i, f"{text_of(i, 3)} {rng.randrange(1, 255)}.{rng.randrange(255)}.10.{rng.randrange(255)} and"))
    return rows


NATIONAL = ["phone (555) 123-4567", "call 555-123-4567", "tel 017 555-7713", "Tel.: (030) 555-0100"]


def test_national_numbers_are_added_and_clean_texts_left_alone(spark):
    rows = _numbers(spark)
    planted = {5000 + n: f"{text_of(n, 6)} {cue} {text_of(n, 5)}" for n, cue in enumerate(NATIONAL)}
    frame = documents(spark, [(i, t, "en", "s") for i, t in [*rows, *planted.items()]])
    trees = pii.fit(pii.cells(frame))
    assert pii.KINDS.index("phone") in trees.thresholds
    got = {r.doc_id: r for r in pii.digest(pii.spans(frame, trees)).collect()}
    for i, text in planted.items():
        number = re.search(r"\(?\d[\d ()-]+\d", text)
        assert got[i].n_phone == 0 and got[i].spans == f"phone:{number.start()}:{number.end()}"
    for i, text in rows:  # nothing is added elsewhere, and base spans stay
        assert got[i].spans == _text(_base(text))
    clean = {r.doc_id: r.text for r in pii.redact(frame, trees).collect()}
    assert all("<phone>" in clean[i] for i in planted)
    assert all(clean[i] == text for i, text in rows if 1000 <= i < 2000)


def test_evidence_is_no_feature(spark):
    assert not {"plus", "cue"} & pii.BINS.keys()
    frame = documents(spark, [(0, "ring +1 (017) 555-7713 now", "en", "s"), (1, "my card 1234567890123", "en", "s")])
    found = {(r.kind, r.digits): (r.right_, r.wrong) for r in pii.cells(frame).collect()}
    phone, card = (pii.KINDS.index(k) for k in ("phone", "card"))
    assert found[phone, 3] == (1, 0) and found[card, 4] == (1, 0)  # the national part; told by its cue
