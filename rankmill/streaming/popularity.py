"""Running activity per window, with every late row counted and kept.

Each micro-batch is split by the watermark: the latest event time of the batches before it, less the
horizon. Rows in time are merged into a table with one row per event id; rows older than that go to a
side table, one folder per batch, and rows without an event time are counted. A note after each batch
holds its number, the latest event time and the running counts, so a batch that is delivered again after
a failure is passed over or gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rankmill.plans import history
from rankmill.plans.staging import parsed_events
from rankmill.session import fresh_dir, use_utc
from rankmill.sources.lake import Lake, path_exists
from rankmill.sources.notes import read_note, write_note

IN_TIME = history.Tables("popular_events", "popular_events_repeats")
LATE, PROGRESS = "late_events", "popularity_progress"
COUNTS = ("rows", "late", "untimed")


def _micros(spark: SparkSession, horizon: str) -> int:
    """A horizon such as `1 hour` in microseconds."""
    epoch = "timestamp '1970-01-01 00:00:00'"
    return spark.sql(f"select unix_micros({epoch} + interval {horizon}) - unix_micros({epoch})").head()[0]


def follow_popularity(
    messages: DataFrame, lake: Lake, checkpoint: str, horizon: str = "1 hour", every: str | None = None
) -> StreamingQuery:
    """Keep the tables behind `popularity` up to date with a stream of messages.

    Without `every` the query takes what is there and stops.
    """
    notes = lake.table(PROGRESS, history.STAGING)
    span = _micros(use_utc(messages.sparkSession), horizon)

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = read_note(spark, notes) or {"batch": -1, "latest": None, **dict.fromkeys(COUNTS, 0)}
        if number <= seen["batch"]:
            return
        limit = seen["latest"] - span if seen["latest"] is not None else None
        at = F.unix_micros("event_ts")
        late = F.coalesce(at < F.lit(limit), F.lit(False)) if limit is not None else F.lit(False)
        told = Observation(f"popularity {number}")
        marked = parsed_events(batch).withColumn("late", late).observe(
            told,
            F.count(F.lit(1)).alias("rows"),
            F.count_if("late").alias("late"),
            F.count_if(at.isNull()).alias("untimed"),
            F.max(at).alias("latest"),
        )
        path = fresh_dir(spark, "popularity-batch")
        marked.write.parquet(path)
        rows = spark.read.schema(marked.schema).parquet(path)
        rows.where("late").drop("late").write.mode("overwrite").parquet(f"{lake.table(LATE, history.STAGING)}/batch={number}")
        in_time = rows.where("not late and event_ts is not null").drop("late")
        history.merge_parsed(spark, lake, in_time, IN_TIME)
        latest = [t for t in (seen["latest"], told.get["latest"]) if t is not None]
        counts = {name: seen[name] + told.get[name] for name in COUNTS}
        write_note(spark, notes, {"batch": number, "latest": max(latest, default=None), **counts})

    writer = messages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def progress(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Rows seen, late ones and those without an event time, over all batches."""
    note = read_note(spark, lake.table(PROGRESS, history.STAGING)) or {}
    return {name: note.get(name, 0) for name in COUNTS}


def late_events(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows that came after their window was final, with the batch they came in."""
    path, schema = lake.table(LATE, history.STAGING), history.CLEAN_SCHEMA.removesuffix(", dt date")
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{schema}, batch bigint")
    return spark.read.schema(f"{schema}, batch bigint").parquet(path)


def popularity(spark: SparkSession, lake: Lake, window: str = "1 day") -> DataFrame:
    """Activity per window and event type over the rows in time, and the late rows that are not in it."""
    clean = IN_TIME.read(spark, lake)[0]
    held = clean.drop("dt").withColumn("late", F.lit(False))
    both = held.unionByName(late_events(spark, lake).drop("batch").withColumn("late", F.lit(True)))
    on_time = ~F.col("late")

    def of(column: str):
        return F.when(on_time, F.col(column))

    return (
        both.groupBy(F.window("event_ts", window).alias("w"), "event_type")
        .agg(
            F.count_if(on_time).alias("events"),
            F.count_distinct(of("user_id")).alias("active_users"),
            F.count_distinct(of("product_id")).alias("touched_products"),
            F.round(F.avg(of("rating")), 2).alias("avg_rating"),
            F.count_if("late").alias("late_rows"),
        )
        .select(F.col("w.start").alias("window_start"), "event_type", "events", "active_users", "touched_products", "avg_rating", "late_rows")
    )
