"""Quality rules whose cutoffs are quantiles of each language and source.

Every document gets integer measures.  The measures of all documents of a (language, source)
group are summed up in a mergeable quantile sketch: counts per bucket of fixed width, which
partial aggregation adds up before any shuffle, so a hot source is a few hundred rows per task.
A cutoff lies ``spread`` quartile distances beyond the quartile, but never closer than ``margin``
to it, so a clean group loses nothing to its own small variation.

Defined cases: a null text has no words and fails; null languages or sources form groups of
their own; repeated rows count as often as they occur; an empty table gives an empty result;
extra columns are kept by :func:`keep_clean` and ignored by :func:`judge`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import SPACES, WORD, let, settle, small, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Share of the words that may lie in repeated windows, in percent.
MAX_REPEAT = 50


@dataclass(frozen=True)
class Rule:
    """A measure, the width of its sketch buckets and how far beyond the quartiles it may go."""

    name: str
    width: int
    margin: int
    spread: int = 6
    below: bool = False


#: All measures are whole numbers: shares in thousandths, word length in hundredths.
RULES = (
    Rule("symbol_share", 10, 60),
    Rule("mark_share", 10, 150),
    Rule("capital_share", 10, 250),
    Rule("digit_share", 10, 150),
    Rule("repeat_share", 10, 350),
    Rule("line_share", 10, 450),
    Rule("word_length", 10, 400, below=True),
)


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _repeated(text: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more."""

    def windows(found: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(1), F.size(found) - 2),
                lambda i: F.struct(
                    F.xxhash64(F.get(found, i - 1), F.get(found, i), F.get(found, i + 1)).alias("h"),
                    i.alias("i"),
                ),
            )
        )

    def covered(ordered: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            return F.coalesce(F.get(ordered, a)["h"] == F.get(ordered, b)["h"], F.lit(False))

        starts = F.filter(
            F.transform(
                F.sequence(F.lit(0), F.size(ordered) - 1),
                lambda k: F.when(same(k, k - 1) | same(k, k + 1), F.get(ordered, k)["i"]),
            ),
            lambda i: i.isNotNull(),
        )
        return let(
            starts,
            lambda s: F.when(F.size(s) == 0, 0).otherwise(
                F.size(F.array_distinct(F.flatten(F.transform(s, lambda i: F.array(i, i + 1, i + 2)))))
            ),
        )

    return let(
        words(text),
        lambda found: F.when(F.size(found) < 4, 0).otherwise(let(windows(found), covered)),
    )


def _repeated_lines(text: Column) -> Column:
    return let(
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
        lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
    )


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts, the verdict of the fixed rules and the measures."""
    text = F.coalesce("text", F.lit(""))
    solid = F.length(text)
    counts = {
        "n_words": F.regexp_count(text, F.lit(WORD)).cast("long"),
        "word_chars": _without(text, SPACES).cast("long"),
        "n_symbols": (solid - _without(text, SYMBOLS)).cast("long"),
        "n_dup_lines": _repeated_lines(text).cast("long"),
        "n_repeat_words": _repeated(text).cast("long"),
        "_marks": solid - _without(text, "!?~^=_/\\{}[]@"),
        "_capitals": solid - _without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ"),
        "_digits": solid - _without(text, "0123456789"),
        "_lines": F.regexp_count(text, F.lit("\n")) + 1,
    }
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")
    )

    def share(part: str, whole: str, scale: int = 1000) -> Column:
        return F.expr(f"{scale} * {part} div greatest({whole}, 1)")

    return docs.withColumns(counts).withColumns(
        {
            "base_failed": failed,
            "symbol_share": share("n_symbols", "word_chars"),
            "mark_share": share("_marks", "word_chars"),
            "capital_share": share("_capitals", "word_chars"),
            "digit_share": share("_digits", "word_chars"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "line_share": share("n_dup_lines", "_lines"),
            "word_length": share("word_chars", "n_words", 100),
        }
    )


def cutoffs(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per language and source: ``<measure>_low`` and ``<measure>_high``.

    Documents that fail the fixed rules don't shape the cutoffs.
    """
    bucket = F.array(
        *(
            F.struct(F.lit(n).alias("rule"), F.expr(f"{r.name} div {r.width}").alias("bucket"))
            for n, r in enumerate(rules)
        )
    )
    group = ("lang", "source", "rule")
    sketch = (
        docs.filter(~F.col("base_failed"))
        .select("lang", "source", F.explode(bucket).alias("x"))
        .groupBy("lang", "source", "x.rule", "x.bucket")
        .agg(F.count("*").alias("n"))
    )
    ordered = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    ranked = sketch.withColumn("upto", F.sum("n").over(ordered)).withColumn(
        "total", F.sum("n").over(whole)
    )
    quartiles = ranked.groupBy(*group).agg(
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
    )

    def fence(n: int, rule: Rule, high: bool) -> Column:
        q1, q3 = F.col("q1") * rule.width, (F.col("q3") + 1) * rule.width
        reach = F.greatest(rule.spread * (q3 - q1), F.lit(rule.margin))
        value = q3 + reach if high else q1 - reach
        return F.max(F.when(F.col("rule") == n, value)).alias(f"{rule.name}_{'high' if high else 'low'}")

    return quartiles.groupBy("lang", "source").agg(
        *(fence(n, r, True) for n, r in enumerate(rules)),
        *(fence(n, r, False) for n, r in enumerate(rules) if r.below),
    )


def _verdict(rules: tuple[Rule, ...]) -> Column:
    fine = ~F.col("base_failed")
    for rule in rules:
        fine &= F.coalesce(F.col(rule.name) <= F.col(f"_cut.{rule.name}_high"), F.lit(True))
        if rule.below:
            fine &= F.coalesce(F.col(rule.name) >= F.col(f"_cut.{rule.name}_low"), F.lit(True))
    return fine


def _judged(docs: DataFrame, limits: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    limits = limits.select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        F.struct(*(c for c in limits.columns if c not in ("lang", "source"))).alias("_cut"),
    )
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return docs.join(small(limits), same, "left").withColumn("kept", _verdict(rules))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: base counts, ``base_failed``, the measures and ``kept``."""
    names = [r.name for r in rules]
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = measured(docs.select("doc_id", "text", "lang", "source"))
    rows = settle(rows.select("doc_id", "lang", "source", *base, *names), "measures")
    limits = settle(cutoffs(rows, rules), "cutoffs")
    return _judged(rows, limits, rules).select("doc_id", *base, "kept", *names)


def keep_clean(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns.

    Documents are written once with their measures: reading them again costs less than measuring
    them again.
    """
    names = [r.name for r in rules]
    own = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang", "source")
    rows = measured(own).select("_row", "lang", "source", "base_failed", *names)
    rows = settle(rows, "measured")
    limits = settle(cutoffs(rows, rules), "cutoffs")
    return _judged(rows, limits, rules).filter("kept").select("_row.*")
