"""Row numbers inside groups, for small and for very large groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankmill.session import shared_dir

# Rows of one group that a single task may sort (narrow rows, and the sort can spill).
ROWS_PER_SORT_TASK = 2_000_000

_SLOT, _PART, _FIRST, _ROWS, _BEFORE = "__slot", "__part", "__first", "__rows", "__before"
_ROW_BITS = 33  # monotonically_increasing_id: partition in the upper bits, row in the lower 33


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    out: str,
    group_rows_bound: int | None = None,
    rows_per_task: int = ROWS_PER_SORT_TASK,
) -> DataFrame:
    """Add gap-free ranks 1..n inside each group.

    `group_rows_bound` is a proven upper bound on the rows of any group. Within
    `rows_per_task` a plain window is used; without a bound, or beyond it, the rank is
    computed by range partitions so that no task ever holds a whole group.
    """
    if group_rows_bound is not None and group_rows_bound <= rows_per_task:
        window = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(out, F.row_number().over(window).cast("bigint"))
    return _rank_by_ranges(df, group, order, out)


def _rank_by_ranges(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """rank = rows of the group in earlier ranges + position inside the own range.

    Range bounds come from sampling, so the ranged rows are checkpointed before they are
    read twice: once for the counts and once for the rows. `order` has to be total.
    """
    shared_dir(df.sparkSession)
    by = [F.col(name).asc_nulls_first() for name in group] + list(order)
    ranged = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn(_SLOT, F.monotonically_increasing_id())
        .checkpoint()
    )
    placed = ranged.withColumn(_PART, F.shiftright(_SLOT, _ROW_BITS))
    # One row per group and range: at most ranges + groups rows.
    ranges = placed.groupBy(*group, _PART).agg(
        F.count(F.lit(1)).alias(_ROWS), F.min(_SLOT).alias(_FIRST)
    )
    earlier = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        *[F.col(name).alias(f"__g_{name}") for name in group],
        F.col(_PART).alias("__g_part"),
        _FIRST,
        F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE),
    )
    same = [F.col(name).eqNullSafe(F.col(f"__g_{name}")) for name in group]
    same.append(F.col(_PART) == F.col("__g_part"))
    return placed.join(offsets, reduce(and_, same)).select(
        *df.columns,
        (F.col(_SLOT) - F.col(_FIRST) + F.col(_BEFORE) + 1).cast("bigint").alias(out),
    )


def top_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, out: str = "rank"
) -> DataFrame:
    """The first `n` rows of each group with their rank.

    The rank filter sits on the window, so map tasks drop all but `n` rows per group
    before the exchange. Spark does that for small `n` only; a larger `n` is cut from the
    range-partitioned ranks.
    """
    if n >= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return rank_within(df, group, order, out).where(F.col(out) <= n)
    window = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn(out, F.row_number().over(window))
        .where(F.col(out) <= n)
        .withColumn(out, F.col(out).cast("bigint"))
    )
