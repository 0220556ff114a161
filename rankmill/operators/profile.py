"""Row, key and duplicate counts of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_profile(df: DataFrame, table: str, key: str) -> DataFrame:
    """One row: rows, distinct keys, rows beyond the first of a key, full duplicate rows.

    Equal rows are folded before the key is looked at, so many copies of one row cost
    one row per map task.
    """
    folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    per_key = folded.groupBy(key).agg(
        F.sum("__copies").alias("__rows"), F.sum(F.col("__copies") - 1).alias("__extra")
    )
    keyed = F.col(key).isNotNull()
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("row_count"),
        F.count_if(keyed).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(keyed, F.col("__rows") - 1)), F.lit(0)).alias("surplus_key_rows"),
        F.coalesce(F.sum("__extra"), F.lit(0)).alias("duplicate_rows"),
    )
