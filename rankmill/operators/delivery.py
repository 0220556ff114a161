"""Comparing published messages with landed ones, and how late they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def delivery_status(sent: DataFrame, landed: DataFrame, key: str = "event_id") -> DataFrame:
    """Per key how often it was sent and how often it landed.

    Both sides meet in one aggregation instead of a join: copies are summed up in the
    map tasks and neither side has to be deduplicated first.
    """
    both = sent.select(key, F.lit(1).alias("s"), F.lit(0).alias("l")).unionAll(
        landed.select(key, F.lit(0).alias("s"), F.lit(1).alias("l"))
    )
    return (
        both.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum("s").alias("times_sent"), F.sum("l").alias("times_landed"))
    )


def lost_keys(status: DataFrame) -> DataFrame:
    return status.where("times_sent > 0 and times_landed = 0")


def delivery_reconcile(sent: DataFrame, landed: DataFrame, key: str = "event_id") -> DataFrame:
    """One row: sent, landed, lost, delivered more than once, landed without being sent."""
    was_sent, has_landed = F.col("times_sent") > 0, F.col("times_landed") > 0
    return delivery_status(sent, landed, key).agg(
        F.count_if(was_sent).alias("sent_events"),
        F.coalesce(F.sum("times_landed"), F.lit(0)).alias("landed_messages"),
        F.count_if(was_sent & has_landed).alias("landed_events"),
        F.count_if(was_sent & ~has_landed).alias("lost_events"),
        F.count_if(F.col("times_landed") > 1).alias("redelivered_events"),
        F.count_if(~was_sent & has_landed).alias("unexpected_events"),
    )


def with_lag(events: DataFrame) -> DataFrame:
    """Add `lag_us`, the microseconds from the event to its publication."""
    return events.withColumn("lag_us", F.unix_micros("publish_time") - F.unix_micros("event_ts"))


def arrival_lag(events: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Lag summary per event type. Quantiles use a sketch of bounded size."""
    lagged = with_lag(events).where(F.col("lag_us").isNotNull())
    quantiles = F.percentile_approx("lag_us", [0.5, 0.95], accuracy)
    return (
        lagged.groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min("lag_us").alias("min_lag_us"),
            F.max("lag_us").alias("max_lag_us"),
            F.round(F.avg("lag_us"), 2).alias("avg_lag_us"),
            quantiles.alias("q"),
        )
        .select("*", F.col("q")[0].alias("p50_lag_us"), F.col("q")[1].alias("p95_lag_us"))
        .drop("q")
    )
