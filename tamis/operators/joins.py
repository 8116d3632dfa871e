"""Equi-joins whose hot keys don't meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least this share of the rows is hot; so there are at most ``1 / SHARE``.
SHARE = 0.02
#: Rows of the other side for hot keys that may be broadcast.
BROADCAST_ROWS = 100_000


def hot_keys(rows: DataFrame, key: str, share: float = SHARE) -> list:
    """The values that hold at least about ``share`` of the rows, nulls aside; a few at most.

    Quantile sketches of the keys' hashes, which tasks build apart and merge: a key with that share
    covers several of the ranks asked for, whatever the other keys are.  What does is then counted.
    """
    hashed = F.shiftright(F.xxhash64(key), 12)  # the sketch holds doubles
    known = rows.where(F.col(key).isNotNull())
    ranks = [n * share / 4 for n in range(1, int(4 / share))]
    found = known.agg(F.approx_percentile(hashed, ranks, round(20 / share)).alias("at"), F.count("*").alias("n")).first()
    if not found.n:
        return []
    again = {h for h in found["at"] if found["at"].count(h) > 1}
    if not again:
        return []
    counts = known.where(hashed.isin(list(again))).groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))
    return [r.key for r in counts.where(F.col("n") >= share * found.n).collect()]


def split_join(
    rows: DataFrame,
    side: DataFrame,
    key: str,
    side_key: str,
    how: str = "left",
    *,
    share: float = SHARE,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """``rows`` joined with ``side`` on one key; other joins than inner and left are not split.

    Rows with a hot or null key stay where they are: ``side``'s rows for the hot keys are broadcast
    if they are few, which is counted.  Only the rest is dealt by key for a sort-merge join.
    ``keys_of`` are rows with the same keys that are cheaper to look for hot ones in.
    """
    same = F.col(key) == F.col(side_key)
    if how not in ("left", "inner"):
        return rows.join(side, same, how)
    hot = hot_keys(rows if keys_of is None else keys_of, key, share)
    of_hot = side.where(F.col(side_key).isin(hot))
    if not hot or of_hot.count() > BROADCAST_ROWS:
        return rows.join(side, same, how)  # skew handling splits what is still hot
    is_hot = F.col(key).isNull() | F.col(key).isin(hot)
    broadcast = rows.where(is_hot).join(F.broadcast(of_hot), same, how)
    return broadcast.unionByName(rows.where(~is_hot).join(side, same, how))
