"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target number of words.  A source that must give more words than it has gives
complete epochs of all its documents first; the rest of its target is a sample: every document
gets the exponential key ``-ln(u) / quality`` with ``u`` from a hash of its id, documents are
sorted by key within the source, and sizes are summed up to the budget.

No source is sorted in one task.  Keys fall into ``CELLS`` cells per source; partial aggregation
adds up the words of each cell, the cells' running sums (``CELLS`` rows per source at most) tell
which cells lie wholly in or out, and only the documents of the cell that the budget cuts are cut
again, ``LEVELS`` times, before what is left is sorted: a ``CELLS ** LEVELS``-th of the source.

Defined cases: a null text has no words and is never taken; a null source is one source, last in
order; documents with a null id share one key; repeated rows are documents of their own, and
of equal documents any may be the one that is cut; an empty table gives an empty result; extra
columns are kept by :func:`mixed` and ignored by :func:`plan`.  Tables of sources are bounded by
the number of sources and are ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import WORD, settle, small

WEIGHTS = (5.0, 2.0, 1.0)
#: A target is at most so many times the words of its source.
MAX_EPOCHS = 3
CELLS, LEVELS = 1024, 2
SEED = "mix"


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the number of words, and ``quality``, the sampling weight.

    The quality is the share of characters other than digits and punctuation, squared; at
    least a quarter.
    """
    text = F.coalesce("text", F.lit(""))
    clean = F.length(F.translate(text, "#*$%&|<>!?~^=_/\\{}[]()@+0123456789", ""))
    share = clean / F.greatest(F.length(text), F.lit(1))
    return docs.withColumns(
        {
            "size": F.regexp_count(text, F.lit(WORD)).cast("long"),
            "quality": F.greatest(share * share, F.lit(0.25)),
        }
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per source of ``sizes`` (source, size): ``source_size``, ``target``.

    Shares of the whole go by weight; what exceeds ``MAX_EPOCHS`` times a source is shared out
    again among the others, until no target is above its bound.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), place.cast("int") + 1)
    sources = settle(
        sources.select(
            "source",
            "source_size",
            weight.alias("weight"),
            (MAX_EPOCHS * F.col("source_size")).cast("double").alias("bound"),
        ),
        "sources",
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, seen = 0.0, -1
    while True:  # each round bounds at least one more source, mostly all that must be
        above = F.col("weight") * level > F.col("bound")
        n, bounded, free = sources.agg(
            F.count_if(above),
            F.sum(F.when(above, F.col("bound")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
        ).first()
        if n == seen or not free:
            break
        level, seen = (total - bounded) / free, n
    target = F.least(F.col("weight") * level, F.col("bound"))
    return sources.select("source", "source_size", target.alias("target"))


def _key() -> Column:
    """The exponential key: 52 bits of the id's hash as a number in (0, 1)."""
    name = F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / float(2**52)) / F.col("quality")


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _rows(docs: DataFrame) -> DataFrame:
    return sized(docs).withColumn("key", _key())


def _goals(rows: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """The target of each source as whole epochs and the budget of the sample."""
    goals = settle(targets(rows.select("source", "size"), weights), "targets")
    whole = F.col("source_size").cast("double")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / whole)).otherwise(0)
    return settle(
        goals.select(
            F.col("source").alias("_source"),
            "source_size",
            "target",
            epochs.cast("long").alias("epochs"),
            F.greatest(F.col("target") - epochs * whole, F.lit(0.0)).alias("budget"),
        ),
        "goals",
    )


def _cell(level: int) -> Column:
    """``key / (1 + key)`` spreads the keys over [0, 1)."""
    return F.floor(F.col("key") / (1.0 + F.col("key")) * CELLS**level).cast("long")


def _running(by: str) -> Window:
    return Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)


def _cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """The last level's cell that the budget of a source cuts, and the words before that cell."""
    cuts = None
    for level in range(1, LEVELS + 1):
        placed = rows.select("source", "size", _cell(level).alias("cell"))
        if cuts is None:
            placed = placed.withColumn("_before", F.lit(0).cast("long"))
        else:
            inside = F.floor(F.col("cell") / CELLS) == F.col("_cell")
            placed = placed.join(small(cuts), _same("source", "_cut") & inside)
        sums = placed.groupBy("source", "cell").agg(
            F.sum("size").alias("n"), F.first("_before").alias("_before")
        )
        upto = F.col("_before") + F.sum("n").over(_running("cell"))
        crossing = (
            sums.withColumn("upto", upto)
            .join(small(goals), _same("source", "_source"))
            .filter("upto > budget")
            .groupBy("source")
            .agg(F.min(F.struct("cell", F.expr("upto - n").alias("before"))).alias("c"))
        )
        cuts = settle(
            crossing.select(
                F.col("source").alias("_cut"),
                F.col("c.cell").alias("_cell"),
                F.col("c.before").alias("_before"),
            ),
            "cuts",
        )
    return cuts


def _chosen(rows: DataFrame, goals: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``taken``."""
    placed = (
        rows.withColumn("cell", _cell(LEVELS))
        .join(small(goals), _same("source", "_source"))
        .join(small(cuts), _same("source", "_cut"), "left")
    )
    cut = F.coalesce(F.col("cell") == F.col("_cell"), F.lit(False))
    clear = placed.filter(~cut).withColumn(
        "sampled", F.coalesce(F.col("cell") < F.col("_cell"), F.lit(True))
    )
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # the document that crosses the budget is taken if most of it lies within
    middle = F.col("_before") + upto - F.col("size") / 2
    within = placed.filter(cut).withColumn("sampled", middle <= F.col("budget"))
    epochs = F.col("epochs") + F.col("sampled").cast("long")
    return clear.unionByName(within).withColumn("taken", F.col("size") * epochs)


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``,
    ``taken`` (words, repeats counted) and ``key``."""
    rows = _rows(docs.select("doc_id", "text", "source")).drop("text")
    rows = settle(rows, "sizes")
    goals = _goals(rows, weights)
    return _chosen(rows, goals, _cuts(rows, goals)).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "key"
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mix with their own columns, a row for each time one is taken.

    Sizes and keys are computed again, so that no text is shuffled.
    """
    own = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "source")
    rows = settle(_rows(own.drop("_row")).drop("text"), "sizes")
    goals = _goals(rows, weights)
    chosen = _chosen(_rows(own), goals, _cuts(rows, goals)).filter("taken > 0")
    times = F.sequence(F.lit(1), F.expr("taken div size"))
    return chosen.select("_row", F.explode(times)).select("_row.*")
