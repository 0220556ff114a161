"""Joining many rows to a list that has one row per key, whatever the key skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a narrow lookup list that every executor can hold.
BROADCAST_ROWS = 200_000
# A key with more than one in so many rows is split, into parts of about that share.
HOT_SHARE = 1000

_SALT, _PARTS = "__salt", "__parts"


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_rows_bound: int,
    spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Inner join of `rows` to a `lookup` that is unique in `key`.

    `lookup_rows_bound` is a proven upper bound on the rows of `lookup`. Up to
    `broadcast_rows` the lookup is broadcast and `rows` stay where they are. Beyond that
    the rows per key are counted first. Keys above the hot share, of which there are fewer
    than `hot_share`, get a number of parts in proportion to their rows: each of their rows
    draws its part from `spread_by`, and only their lookup rows are repeated once per part.
    All other keys are joined as they are. (The skew handling of AQE does not cover this
    join, as it needs a bare exchange below each side and the lookup is usually an aggregate.)
    """
    if lookup_rows_bound <= broadcast_rows:
        return rows.join(F.broadcast(lookup), key)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    part = F.lit(rows.count()) / hot_share
    hot = F.broadcast(counts.where(F.col("n") > part).select(key, F.ceil(F.col("n") / part).cast("int").alias(_PARTS)))
    parts = F.coalesce(_PARTS, F.lit(1))
    salted = rows.join(hot, key, "left").withColumn(_SALT, F.pmod(F.xxhash64(spread_by), parts).cast("int"))
    copies = lookup.join(hot, key, "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.drop(_PARTS).join(copies.drop(_PARTS), [key, _SALT]).drop(_SALT)
