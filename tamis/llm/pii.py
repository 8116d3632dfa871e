"""Personal data: loose generators, boosted trees and calibrated thresholds.

Base patterns with their checks (Luhn, octets, numbers of digits) always count.  Besides, loose
generators propose spans that may overlap, among them the national part of a number with a country
code.  A proposal has a few small features of its format and of what is beside it.  Whether it is
right is told by evidence that is none of them: it lies where a base span of its kind does (whose sign
or check digit the features don't show), or a cue word stands before it.  So trees that are fitted to
what international numbers look like know national ones, which no base pattern finds.

Boosted trees are fitted to the counts of right and wrong proposals in each cell of features, summed
up over all documents; the cells are bounded by the bins of the features, not by the data.  For each
kind, the lowest score at and above which proposals in the other half of the documents were right
often enough selects the additional spans, those that no base span covers.  Everything that touches
texts is column expressions; the trees are ``CASE`` expressions.

Positions come from splitting a text at the matches: the lengths of the pieces add up.

Defined cases: a null text is an empty one and has no spans; empty tables give empty results;
documents are judged one by one, so ties, repeated rows and null ids are no matter; extra columns
are kept by :func:`redact` and ignored by :func:`spans`.  If no proposal exists, only base spans
count.  Spans may overlap; :func:`redact` joins them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import let

KINDS = ("email", "ip", "card", "phone")

#: Possessive repeats match the same as plain ones here, since what follows a repeat never
#: begins like the repeated part; they need neither stack nor a second try.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this can't match.
HINT = {"email": "@", "phone": "+"}
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[a-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[a-z0-9-]{1,63}+)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[.,][0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4,19}+(?:[\x20./-][0-9]{1,7}+)*+(?![0-9])",
    "phone": r"(?<![0-9+])\+?\(?[0-9]{1,5}+(?:[\x20()./-]{1,2}+[0-9]{2,5}+){2,5}+(?![0-9])",
}
#: Digits that a proposal may have.
LOOSE_DIGITS = {"email": (0, 99), "ip": (4, 12), "card": (13, 19), "phone": (7, 15)}
#: Words before a proposal that speak for its kind, whatever they end in.
CUES = {
    "email": "mail|contact|write|contacto|correo|courriel|schreib",
    "ip": "ip|addr|host|server|login",
    "card": "card|visa|credit|pay|tarjeta|carte|karte",
    "phone": "phone|tel|call|mobil|fax|llam|appel|anruf",
}
#: A cue word, at most two short words, and marks.
BEFORE = r"(?i)(?<!\p{L})(?:%s)\p{L}*+[^\p{L}0-9]{0,4}(?:\p{L}{1,6}[^\p{L}0-9]{1,3}){0,2}$"
#: The country code of a number that has one.
COUNTRY = r"^\+[0-9]{1,3}[\x20.-]{1,2}(?=\(?[0-9])"
#: Bins of each feature; their product bounds the cells.
BINS = {"kind": 4, "digits": 8, "groups": 5, "marks": 4, "left": 4, "right": 4}
CHUNK = 256


def _items(text: Column, pattern: str) -> Column:
    """The matches, leftmost first: ``start``, ``end`` (code points), ``match``, the ``left``
    context and the ``next`` character."""
    item = "struct<start:int,end:int,match:string,left:string,next:string>"

    def step(state: Column, piece: Column) -> Column:
        start = state["pos"] + F.length(piece["gap"])
        end = start + F.length(piece["match"])
        own = F.struct(
            start.alias("start"),
            end.alias("end"),
            piece["match"].alias("match"),
            F.right(piece["gap"], F.lit(24)).alias("left"),
            F.left(piece["after"], F.lit(1)).alias("next"),
        )
        return F.struct(end.alias("pos"), F.concat(state["all"], F.array(own)).alias("all"))

    def chunk(state: Column, pieces: Column) -> Column:
        """Arrays grow by a copy of the old one, so they are kept short."""
        start = F.struct(state["pos"].alias("pos"), F.array().cast(f"array<{item}>").alias("all"))
        return let(
            F.aggregate(pieces, start, step),
            lambda done: F.struct(
                done["pos"].alias("pos"),
                F.concat(state["all"], F.array(done["all"])).alias("all"),
            ),
        )

    def placed(matches: Column) -> Column:
        n = F.size(matches)
        gaps = F.split(text, pattern, -1)
        pieces = F.arrays_zip(
            F.slice(gaps, F.lit(1), n).alias("gap"),
            matches.alias("match"),
            F.slice(gaps, F.lit(2), n).alias("after"),
        )
        chunks = let(
            pieces,
            lambda p: F.transform(
                F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")),
                lambda c: F.slice(p, c * CHUNK + 1, F.lit(CHUNK)),
            ),
        )
        start = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<array<{item}>>").alias("all"))
        all_ = F.flatten(F.aggregate(chunks, start, chunk)["all"])
        return F.when(n > 0, all_).otherwise(F.array().cast(f"array<{item}>"))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, less nine if above nine."""

    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, b: a + b
    )
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":

        def octet(part: Column) -> Column:
            last = F.concat(F.lit("0"), F.right(part, F.lit(3))).cast("int")
            return F.when(F.length(F.ltrim(part, F.lit("0"))) <= 3, last <= 255).otherwise(False)

        return F.forall(F.split(match, r"\."), octet)
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _base(text: Column, kind: str) -> Column:
    found = F.filter(_items(text, BASE[kind]), lambda m: _valid(kind, m["match"]))
    if kind in HINT:
        found = F.when(F.contains(text, F.lit(HINT[kind])), found).otherwise(F.slice(found, 1, 0))
    return F.transform(found, lambda m: _span(kind, m))


def _span(kind: str, m: Column) -> Column:
    return F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")
    )


def _bin(value: Column, *bounds: int) -> Column:
    """The number of bounds that the value reaches."""
    return sum((F.when(value >= b, 1).otherwise(0) for b in bounds), F.lit(0))


def _beside(char: Column) -> Column:
    return (
        F.when(F.coalesce(F.length(char), F.lit(0)) == 0, 0)
        .when(char.rlike(r"\s"), 1)
        .when(char.rlike(r"[\p{L}0-9_]"), 2)
        .otherwise(3)
    )


def _proposal(kind: str, m: Column) -> Column:
    match = m["match"]
    digits = F.length(_digits(match))
    marks = (
        F.when(match.rlike(r"[\[\]@]"), 3)
        .when(match.rlike(r"[./,]"), 0)
        .when(match.rlike(r"[() -]"), 2)
        .otherwise(1)
    )
    return F.struct(
        m["start"].alias("start"),
        F.lit(KINDS.index(kind)).alias("kind"),
        m["end"].alias("end"),
        _bin(digits, 4, 7, 10, 12, 14, 16, 17).alias("digits"),
        _bin(F.regexp_count(match, F.lit("[0-9]+")), 2, 3, 4, 5).alias("groups"),
        marks.alias("marks"),
        _beside(F.right(m["left"], F.lit(1))).alias("left"),
        _beside(m["next"]).alias("right"),
        m["left"].rlike(BEFORE % CUES[kind]).alias("cue"),
    )


def _national(m: Column) -> Column:
    """A number without its country code."""
    rest = F.regexp_replace(m["match"], COUNTRY, "")
    cut = F.length(m["match"]) - F.length(rest)
    return F.struct(
        (m["start"] + cut).alias("start"),
        m["end"].alias("end"),
        rest.alias("match"),
        F.right(F.left(m["match"], cut), F.lit(24)).alias("left"),
        m["next"].alias("next"),
    )


def _proposals(text: Column) -> Column:
    def of(kind: str) -> Column:
        low, high = LOOSE_DIGITS[kind]
        fits = lambda m: F.length(_digits(m["match"])).between(low, high)
        found = _items(text, LOOSE[kind])
        if kind == "phone":
            coded = lambda m: m["match"].rlike(COUNTRY)
            found = let(found, lambda x: F.concat(x, F.transform(F.filter(x, coded), _national)))
        found = F.filter(found, fits)
        if kind == "email":
            found = F.when(text.rlike(r"(?i)@|[(\[]at[)\]]"), found).otherwise(F.slice(found, 1, 0))
        return F.transform(found, lambda m: _proposal(kind, m))

    return F.concat(*(of(kind) for kind in KINDS))


def _found(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` (by start, then kind) and ``_more``, the proposals."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("_text", text).withColumns(
        {
            "_base": F.sort_array(F.concat(*(_base(F.col("_text"), kind) for kind in KINDS))),
            "_more": _proposals(F.col("_text")),
        }
    )


def cells(docs: DataFrame) -> DataFrame:
    """Counts of right and wrong proposals in each cell of features, by half of the documents."""
    found = _found(docs.select("doc_id", "text"))
    half = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2
    rows = found.select(half.alias("half"), "_base", F.explode("_more").alias("p"))

    def same(b: Column) -> Column:
        overlap = (b["start"] < F.col("p.end")) & (b["end"] > F.col("p.start"))
        return overlap & (b["kind"] == F.col("p.kind"))

    right = (F.exists("_base", same) | F.col("p.cue")).cast("long")
    return rows.groupBy("half", *(F.col(f"p.{f}").alias(f) for f in BINS)).agg(
        F.sum(right).alias("right_"), F.sum(1 - right).alias("wrong")
    )


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: str
    at: int
    low: Leaf | Split
    high: Leaf | Split


@dataclass(frozen=True)
class Trees:
    """The sum of the trees is a log-odds; a kind without threshold has no additional spans."""

    trees: tuple[Leaf | Split, ...]
    thresholds: dict[int, float]

    def score(self, features: Column) -> Column:
        def case(tree: Leaf | Split) -> Column:
            if isinstance(tree, Leaf):
                return F.lit(tree.value)
            low = features[tree.feature] <= tree.at
            return F.when(low, case(tree.low)).otherwise(case(tree.high))

        return sum((case(tree) for tree in self.trees), F.lit(0.0))

    def selects(self, features: Column) -> Column:
        chosen = F.lit(False)
        for kind, least in self.thresholds.items():
            chosen |= (features["kind"] == kind) & (self.score(features) >= least)
        return chosen


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, rate: float) -> Leaf | Split:
    """A tree for the gradients: the split that gains most, as in Newton boosting."""
    names, best = list(BINS), (1e-6, None)
    whole = g.sum() ** 2 / (h.sum() + 1.0)
    if depth:
        for f, name in enumerate(names):
            gs = np.bincount(x[:, f], g, BINS[name]).cumsum()
            hs = np.bincount(x[:, f], h, BINS[name]).cumsum()
            gain = gs**2 / (hs + 1.0) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1.0) - whole
            at = int(gain[:-1].argmax())
            if gain[at] > best[0]:
                best = (gain[at], (f, at))
    if not best[1]:
        return Leaf(float(rate * g.sum() / (h.sum() + 1.0)))
    f, at = best[1]
    low = x[:, f] <= at
    sides = (_grow(x[side], g[side], h[side], depth - 1, rate) for side in (low, ~low))
    return Split(names[f], at, *sides)


def _values(tree: Leaf | Split, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, Leaf):
        return np.full(len(x), tree.value)
    low = x[:, list(BINS).index(tree.feature)] <= tree.at
    return np.where(low, _values(tree.low, x), _values(tree.high, x))


def fit(
    counts: DataFrame, rounds: int = 20, depth: int = 3, rate: float = 0.4, precision: float = 0.95
) -> Trees:
    """Trees from the counts of one half of the documents, thresholds from the other half."""
    rows = counts.select("half", *BINS, "right_", "wrong").orderBy("half", *BINS).collect()
    table = np.array([tuple(r) for r in rows], dtype="int64").reshape(-1, len(BINS) + 3)
    x, right, wrong = table[:, 1:-2], table[:, -2].astype(float), table[:, -1].astype(float)
    learn = table[:, 0] == 0
    total, trees = np.zeros(len(table)), []
    for _ in range(rounds if learn.any() else 0):
        p = 1 / (1 + np.exp(-total[learn]))
        n = right[learn] + wrong[learn]
        trees.append(_grow(x[learn], right[learn] - n * p, n * p * (1 - p), depth, rate))
        total += _values(trees[-1], x)
    thresholds = {}
    for kind in range(len(KINDS)):
        own = ~learn & (x[:, 0] == kind)
        # by score from the top: all above a threshold, and those at it, must be right
        scores, level = np.unique(-total[own].round(9), return_inverse=True)
        hits, misses = (np.bincount(level, x[own], len(scores)) for x in (right, wrong))
        above = hits.cumsum() / (hits.cumsum() + misses.cumsum() + 0.5)
        good = np.flatnonzero((above >= precision) & (2 * hits >= hits + misses + 1) & (scores < 0))
        if len(good):
            thresholds[kind] = float(-scores[good[-1]]) - 1e-6
    return Trees(tuple(trees), thresholds)


def _text_of(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])
    )
    return F.array_join(F.array_distinct(parts), ",")


def _all(trees: Trees) -> Column:
    """Base and selected spans by start, then kind."""

    def new(p: Column) -> Column:
        covered = F.exists("_base", lambda b: (b["start"] <= p["start"]) & (b["end"] >= p["end"]))
        return trees.selects(p) & ~covered

    more = F.filter("_more", new)
    own = F.transform(more, lambda p: F.struct(p["start"], p["kind"], p["end"]))
    return F.sort_array(F.concat("_base", own))


def spans(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans``, arrays of (start, kind, end)."""
    docs = docs.select("doc_id", "text")
    trees = trees or fit(cells(docs))
    return _found(docs).select("doc_id", F.col("_base").alias("base"), _all(trees).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The result of :func:`spans` as counts of base spans, a hash of them and all spans' text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)),
        F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"),
        _text_of(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets.

    Overlapping spans are replaced as one, by the kind of the first.
    """
    trees = trees or fit(cells(docs))
    own = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    found = _found(own).withColumn("_all", _all(trees))
    name = F.array(*(F.lit(f"<{kind}>") for kind in KINDS))

    def step(state: Column, s: Column) -> Column:
        """What precedes the span and its replacement; an overlap only moves the end."""
        fresh = s["start"] >= state["end"]
        gap = F.col("_text").substr(state["end"] + 1, s["start"] - state["end"])
        own = F.concat(gap, F.get(name, s["kind"]))
        return F.struct(
            F.greatest(state["end"], s["end"]).alias("end"),
            F.when(fresh, F.concat(state["all"], F.array(own))).otherwise(state["all"]).alias("all"),
        )

    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("all"))
    text = let(
        F.aggregate("_all", start, step),
        lambda done: F.concat(
            F.array_join(done["all"], ""),
            F.col("_text").substr(done["end"] + 1, F.length("_text") - done["end"]),
        ),
    )
    clean = F.when(F.size("_all") > 0, text).otherwise(F.col("text"))
    return found.select(F.col("_row").withField("text", clean).alias("_row")).select("_row.*")
