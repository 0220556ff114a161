"""Selecting one daily snapshot out of a date-partitioned table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_snapshot(raw: DataFrame, as_of: dt.date | str | None = None, dt_col: str = "dt") -> DataFrame:
    """Rows of the newest partition, or of the pinned `as_of` partition.

    On a table partitioned by `dt_col` the condition reaches the scan as a partition
    filter. The maximum itself reads no data column; callers that know the date from the
    partition listing (`sources.lake.Lake.latest_date`) pass it and spare that pass too.
    """
    day = F.lit(str(as_of)).cast("date") if as_of is not None else raw.agg(F.max(dt_col)).scalar()
    return raw.where(F.col(dt_col) == day)
