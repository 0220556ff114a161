"""Event messages as a stream: landing as they come, cleaning within a horizon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankmill.plans import history
from rankmill.plans.staging import parsed_events
from rankmill.sources.lake import RETENTION_DAYS, Lake
from rankmill.sources.notes import read_note, write_note
from rankmill.sources.schemas import EVENT_MESSAGE, STREAMED

MERGED = history.Tables("merged_events", "merged_events_repeats")


def message_files(
    spark: SparkSession, path: str, fmt: str = "json", files_per_batch: int = 1000, max_age: str = "3650d"
) -> DataFrame:
    """A stream over message files that keep arriving in a folder.

    Spark passes over files that are older than the newest one by more than `max_age`; its own
    default of a week would lose files that arrive late.
    """
    return (
        spark.readStream.schema(EVENT_MESSAGE)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", max_age)
        .format(fmt)
        .load(path)
    )


def from_kafka(records: DataFrame, subscription: str) -> DataFrame:
    """Records of the `kafka` source (read with `includeHeaders`) in message form.

    The payload stays untouched, the metadata is kept.
    """
    headers = F.transform(
        "headers", lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value"))
    )
    return records.select(
        F.lit(subscription).alias("subscription_name"),
        F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")).alias(
            "message_id"
        ),
        F.col("timestamp").alias("publish_time"),
        F.col("value").cast("string").alias("data"),
        F.to_json(headers).alias("attributes"),
    )


def land_events(
    messages: DataFrame,
    lake: Lake,
    checkpoint: str,
    every: str | None = None,
    retention_days: int = RETENTION_DAYS,
) -> StreamingQuery:
    """Append messages to the raw event table, by the UTC date of their publication.

    Nothing is parsed or dropped here. Without `every` the query takes what is there and
    stops. The sink's own file log forgets files older than the retention time.
    """
    writer = (
        messages.withColumn("dt", F.to_date("publish_time"))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("dt")
        .option("checkpointLocation", checkpoint)
        .option("retention", f"{retention_days}d")
    )
    timed = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return timed.start(lake.table(STREAMED, "raw"))


def merge_stream(messages: DataFrame, lake: Lake, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """One row per event id over the whole history, kept up to date batch by batch.

    The table equals the batch model over all messages: copies count however far apart they arrive, as
    there is no horizon and no state beside the tables. A batch that is delivered again after a failure
    merges the same rows; one that the ledger lists as done is passed over. Read it with `merged_events`.
    """
    ledger = lake.table("merged_batches", history.STAGING)

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = read_note(spark, ledger) or {"checkpoint": checkpoint, "batch": -1}
        if done["checkpoint"] == checkpoint and number <= done["batch"]:
            return
        history.merge_parsed(spark, lake, parsed_events(batch), MERGED)
        write_note(spark, ledger, {"checkpoint": checkpoint, "batch": number})

    writer = messages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def merged_events(spark: SparkSession, lake: Lake) -> DataFrame:
    """What `merge_stream` has merged so far."""
    return MERGED.read(spark, lake)[0].drop("dt")


def dedup_stream(messages: DataFrame, horizon: str = "1 hour") -> DataFrame:
    """Parsed events, one per id, for copies that arrive within `horizon` of each other.

    State is kept per id and dropped once the watermark has passed. The copy that arrives
    first is kept, which need not be the one published first; messages later than the
    horizon are dropped. The batch model, which the marts use, has neither limit.
    """
    return (
        parsed_events(messages)
        .withWatermark("publish_time", horizon)
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def live_popularity(messages: DataFrame, window: str = "1 day", horizon: str = "1 hour") -> DataFrame:
    """Running activity per window and event type, without repeated deliveries.

    Copies of an event share its time stamp, so one watermark serves both steps: an id is
    remembered for `horizon` of event time, and a window is final once the watermark has
    passed its end. Users and products are estimated, since exact distinct counts would
    need the full sets in state.
    """
    return (
        parsed_events(messages)
        .where(F.col("event_ts").isNotNull())
        .withWatermark("event_ts", horizon)
        .dropDuplicatesWithinWatermark(["event_id"])
        .groupBy(F.window("event_ts", window), "event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.approx_count_distinct("user_id").alias("active_users"),
            F.approx_count_distinct("product_id").alias("touched_products"),
            F.round(F.avg("rating"), 2).alias("avg_rating"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "event_type",
            "events",
            "active_users",
            "touched_products",
            "avg_rating",
        )
    )
