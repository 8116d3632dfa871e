"""Chat formatting: collapse cumulative snapshots, render what is left.

A logged conversation that is a prefix of a longer one (or equals one with a smaller id) is a
snapshot.  The rolling hash at turn ``k`` stands for the first ``k`` turns: the XOR of the
position-salted hashes of these turns, a running window aggregate.  Only hashes are shuffled for
the search; a prefix that thousands of conversations share is one row per task.  The texts of
maximal conversations are then gathered in one exchange: those of snapshots are left out before it
(or, beyond ``NAMES`` ids, in it).

Defined cases: turns with a null number come first, ties are ordered by their hash; a null role
renders as ``unknown``, a null text as empty, yet both differ from those values in the search;
a turn without a conversation id is a conversation of its own, with a null id, so such turns are
never gathered; repeated turns are turns; an empty table gives an empty result; extra columns are
ignored.  A rendered conversation must fit in memory, each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.common import settle, small

#: Kept conversations whose ids may be broadcast to the texts.
NAMES = 1_000_000
#: How a turn and its end are written.
TURN_START, TURN_END = "<|{role}|>\n", "\n<|end|>\n"


def _hash(seed: int, *columns: str) -> Column:
    """64 bits of the values; null and empty differ."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts)


def prefixes(turns: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id``, ``k``, the hashes ``a`` and ``b`` of the first ``k`` turns,
    ``n_turns`` of the conversation."""
    hashed = turns.filter("conv_id is not null").select(
        "conv_id", "turn", *(_hash(seed, "role", "text").alias(h) for seed, h in ((1, "a"), (2, "b")))
    )
    whole = Window.partitionBy("conv_id")
    ordered = whole.orderBy("turn", "a", "b")
    # the salted hashes have names of their own: windows of one order share one sort
    salted = {f"own_{h}": F.xxhash64("k", h) for h in ("a", "b")}
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return (
        hashed.withColumn("k", F.row_number().over(ordered))
        .withColumns(salted)
        .select(
            "conv_id",
            "k",
            *(F.bit_xor(f"own_{h}").over(upto).alias(h) for h in ("a", "b")),
            F.count("*").over(whole).alias("n_turns"),
        )
    )


def _alone(turns: DataFrame) -> DataFrame:
    """The different turns without a conversation id: ``a`` and ``b`` as of a first turn,
    ``n_copies``, ``rendered``."""
    rows = turns.filter("conv_id is null")
    hashes = [F.xxhash64(F.lit(1), _hash(seed, "role", "text")).alias(h) for seed, h in ((1, "a"), (2, "b"))]
    rows = rows.select(*hashes, _piece().alias("rendered"))
    return rows.groupBy("a", "b").agg(F.count("*").alias("n_copies"), F.min("rendered").alias("rendered"))


def maximal(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``n_copies`` of conversations that prefix no other one; with a
    null id also ``rendered``, the turn itself."""
    rows = prefixes(turns)
    key = ["k", "a", "b"]
    named = (
        rows.filter("k = n_turns")
        .groupBy(*key)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    )
    alone = _alone(turns).withColumn("k", F.lit(1))
    both = named.withColumn("rendered", F.lit(None).cast("string")).unionByName(
        alone.withColumn("conv_id", F.lit(None).cast("long")).select(*key, "conv_id", "n_copies", "rendered")
    )
    whole = both.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_copies").alias("n_copies"), F.max("rendered").alias("rendered")
    )
    longer = rows.filter("k < n_turns").select(*key).distinct()
    return whole.join(longer, key, "left_anti").select(
        "conv_id", F.col("k").cast("long").alias("n_turns"), "n_copies", "rendered"
    )


def _piece() -> Column:
    """A turn as it is written."""
    start, end = TURN_START.split("{role}")
    return F.concat(
        F.lit(start),
        F.coalesce("role", F.lit("unknown")),
        F.lit(end),
        F.trim(F.coalesce("text", F.lit(""))),
        F.lit(TURN_END),
    )


def render(turns: DataFrame) -> DataFrame:
    """``conv_id`` and the ``rendered`` text of each conversation."""
    order = [_hash(seed, "role", "text").alias(h) for seed, h in ((1, "a"), (2, "b"))]
    rows = turns.select("conv_id", F.struct("turn", *order, _piece().alias("piece")).alias("t"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["piece"]), "")
    return rows.groupBy("conv_id").agg(joined.alias("rendered"))


def collapse(turns: DataFrame) -> DataFrame:
    """Maximal conversations: ``conv_id``, ``n_turns``, ``n_copies``, ``rendered``."""
    turns = turns.select(F.col("conv_id").cast("long"), "turn", "role", "text")
    kept = settle(maximal(turns), "maximal")
    named = small(kept.filter("conv_id is not null").select("conv_id", "n_turns", "n_copies"), NAMES)
    # plain equality on the id: the join, the gathering and the join below have one partitioning
    texts = turns.join(named.select("conv_id"), "conv_id", "left_semi")
    rendered = render(texts).join(named, "conv_id")
    columns = ["conv_id", "n_turns", "n_copies", "rendered"]
    return rendered.select(*columns).unionByName(kept.filter("conv_id is null").select(*columns))
