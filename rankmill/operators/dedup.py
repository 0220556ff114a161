"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POSITION = "__position"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order; NULL keys form one group.

    `row_number() = 1` is planned with a group limit on both sides of the exchange, so
    each map task sends at most one row per key. A key that holds a large share of the
    table therefore reaches its reducer as one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_POSITION, F.row_number().over(window))
        .where(F.col(_POSITION) == 1)
        .drop(_POSITION)
    )


def remaining_order(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Order by every column not in `used`, which makes the survivor deterministic."""
    return [F.col(name).asc_nulls_last() for name in df.columns if name not in used]
