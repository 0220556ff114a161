"""The registered queries: every model and operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.functions.scalars import partition_key
from rankmill.operators.delivery import arrival_lag, delivery_reconcile, delivery_status, lost_keys, with_lag
from rankmill.operators.profile import table_profile
from rankmill.operators.quality import ACCEPTED, Check, DataQualityError, enforce, quality_report
from rankmill.operators.ranking import rank_within, top_n_per_group
from rankmill.operators.snapshot import latest_snapshot
from rankmill.plans import analysis, checks, daily, history, marts, serving, sketches, staging
from rankmill.session import fresh_dir, run_together
from rankmill.sources import lake as lakes
from rankmill.sources import pages
from rankmill.sources.schemas import SNAPSHOTS
from rankmill.streaming import events as streams
from rankmill.streaming import popularity as live
from workload.adapter import NEW_DAY, OLD_DAY, Tables

Query = Callable[[SparkSession, str], DataFrame]


# -- models -------------------------------------------------------------------------------


def _events(t: Tables) -> DataFrame:
    return staging.stg_events(t.raw_events())


def _mart(t: Tables, events: DataFrame | None = None, **bounds: int) -> DataFrame:
    return marts.recommendations(
        _events(t) if events is None else events,
        staging.stg_products(t.products(), NEW_DAY),
        staging.stg_regulation(t.regulation(), NEW_DAY),
        **bounds,
    )


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(Tables(spark, sf_dir))


def product_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return marts.product_risk(
        staging.stg_products(t.products(), NEW_DAY), staging.stg_regulation(t.regulation(), NEW_DAY)
    )


def product_risk_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a rule list too long to broadcast: hot ingredients are split."""
    t = Tables(spark, sf_dir)
    return marts.product_risk(
        staging.stg_products(t.products(), NEW_DAY),
        staging.stg_regulation(t.regulation(), NEW_DAY),
        broadcast_rows=0,
    )


def recommendations_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a catalog too large for one sort task: ranks by key ranges."""
    return _mart(Tables(spark, sf_dir), rows_per_task=0)


def skin_product_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.skin_product_scores(_events(Tables(spark, sf_dir)))


def stg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(Tables(spark, sf_dir))


def stg_ingredient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_ingredient(Tables(spark, sf_dir).ingredient())


def stg_regulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_regulation(Tables(spark, sf_dir).regulation())


def stg_manufacturer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_manufacturer(Tables(spark, sf_dir).manufacturer())


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array is shown as text so that the comparison does not depend on a list type."""
    products = staging.stg_products(Tables(spark, sf_dir).products())
    return products.withColumn("key_ingredients", F.array_join("key_ingredients", "|"))


def stg_regulation_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_regulation(Tables(spark, sf_dir).regulation(), as_of=OLD_DAY)


def latest_snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_snapshot(Tables(spark, sf_dir).manufacturer())


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.events_daily(_events(Tables(spark, sf_dir)))


# -- reports ------------------------------------------------------------------------------


def kpi_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.kpi_scorecard(events_daily(spark, sf_dir))


def regulated_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return analysis.regulated_origin(
        latest_snapshot(t.ingredient(), NEW_DAY), latest_snapshot(t.regulation(), NEW_DAY)
    )


def regulated_origin_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report as a job over landed JSON lines, read back from its dated folder."""
    t = Tables(spark, sf_dir)
    lake = lakes.Lake(fresh_dir(spark, "origin"))
    for name in ("ingredient", "regulation"):
        snapshot = latest_snapshot(getattr(t, name)(), NEW_DAY).drop("dt")
        lakes.write_snapshot(lake, snapshot, name, NEW_DAY)
    return daily.regulated_origin_report(spark, lake, NEW_DAY)


def serve_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.recommend(_mart(Tables(spark, sf_dir)), "sensitive", 20)


def dashboard_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.dashboard_top(_mart(Tables(spark, sf_dir)))


def top_scores_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = skin_product_scores(spark, sf_dir)
    ranked = top_n_per_group(scores, ["skin_type"], [F.desc("score"), F.asc("product_id")], 10)
    return ranked.select("skin_type", "product_id", F.round("score", 2).alias("score"), "rank")


def rank_in_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full ranks without a size bound: the range-partitioned path."""
    ranked = rank_within(
        skin_product_scores(spark, sf_dir),
        ["skin_type"],
        [F.desc("score"), F.asc("product_id")],
        "rank",
    )
    return ranked.select("skin_type", "product_id", F.round("score", 2).alias("score"), "rank")


def catalog_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.catalog_names(stg_ingredient(spark, sf_dir))


def catalog_names_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog names with a limit that cuts."""
    return analysis.catalog_names(stg_ingredient(spark, sf_dir), limit=150)


def topk_match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return analysis.topk_match_rate(_mart(t), staging.stg_products(t.products(), NEW_DAY))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # three models read the cleaned events, so they are written once
    path = fresh_dir(spark, "clean-events")
    clean = _events(t)
    clean.write.parquet(path)
    events = spark.read.schema(clean.schema).parquet(path)
    models = {
        "stg_ingredient": staging.stg_ingredient(t.ingredient(), NEW_DAY),
        "stg_regulation": staging.stg_regulation(t.regulation(), NEW_DAY),
        "stg_manufacturer": staging.stg_manufacturer(t.manufacturer(), NEW_DAY),
        "stg_products": staging.stg_products(t.products(), NEW_DAY),
        "stg_events": events,
        "recommendations": _mart(t, events),
        "dashboard_events_daily": marts.events_daily(events),
    }
    return quality_report(models)


def quality_of_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same checks on tables before deduplication, where they do find violations."""
    t = Tables(spark, sf_dir)
    raw_ingredient = latest_snapshot(t.ingredient(), NEW_DAY).withColumnRenamed(
        "INGR_KOR_NAME", "ingredient_name_kr"
    )
    raw_company = latest_snapshot(t.manufacturer(), NEW_DAY).withColumnRenamed("ENTP_SEQ", "company_seq")
    return quality_report(
        {
            "stg_ingredient": raw_ingredient,
            "stg_manufacturer": raw_company,
            "stg_events": staging.parsed_events(t.raw_events()),
        }
    )


def table_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    keys = {"ingredient": "INGR_KOR_NAME", "regulation": "INGR_STD_NAME", "manufacturer": "ENTP_SEQ"}
    tables = {name: latest_snapshot(getattr(t, name)(), NEW_DAY) for name in keys}
    return reduce(DataFrame.unionAll, [table_profile(tables[n], n, k) for n, k in keys.items()])


# -- events -------------------------------------------------------------------------------


def _landed_ids(t: Tables) -> DataFrame:
    return staging.parsed_events(t.raw_events(lossy=True)).select("event_id")


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return delivery_reconcile(t.sent_events(), _landed_ids(t))


def lost_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return lost_keys(delivery_status(t.sent_events(), _landed_ids(t))).select("event_id", "times_sent")


def lag_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrival_lag(_events(Tables(spark, sf_dir)))


def _message_folder(t: Tables) -> str:
    folder = fresh_dir(t.spark, "messages")
    t.raw_events().write.parquet(folder)
    return folder


def _landed(t: Tables, label: str) -> lakes.Lake:
    """A lake whose raw event table was filled by the landing stream."""
    lake = lakes.Lake(fresh_dir(t.spark, label))
    messages = streams.message_files(t.spark, _message_folder(t), "parquet")
    streams.land_events(messages, lake, f"{lake.root}/checkpoint").awaitTermination()
    return lake


def landed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    landed = lakes.read_events(spark, _landed(t, "landing"))
    return landed.select("message_id", "publish_time", "data", "dt")


def stream_dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-side dedup, summed up by event type (which copy survives may differ)."""
    t = Tables(spark, sf_dir)
    out = fresh_dir(spark, "dedup")
    messages = streams.message_files(spark, _message_folder(t), "parquet")
    clean = streams.dedup_stream(messages, horizon="60 days")
    (
        clean.writeStream.format("parquet")
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    events = spark.read.parquet(out)
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("event_ids")
    )


def incremental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned events after a full build and a partial refresh of the later days."""
    lake = lakes.Lake(fresh_dir(spark, "refresh"))
    lakes.write_events(lake, Tables(spark, sf_dir).raw_events())
    daily.refresh_events(spark, lake)
    return daily.refresh_events(spark, lake, since="2024-01-20")


def incremental_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from daily sums, after a full build and a partial refresh."""
    lake = lakes.Lake(fresh_dir(spark, "activity"))
    lakes.write_events(lake, Tables(spark, sf_dir).raw_events())
    daily.refresh_events(spark, lake)
    daily.refresh_activity(spark, lake)
    daily.refresh_events(spark, lake, since="2024-01-20")
    return marts.scores_from_activity(daily.refresh_activity(spark, lake, since="2024-01-20"))


def _two_batches(t: Tables) -> list[DataFrame]:
    """The messages in two batches: each has copies of the other's events, on the same days and others."""
    messages = t.raw_events()
    number = "(cast(substring_index(substr(message_id, 3), '-', 1) as bigint) + cast(right(message_id, 1) as int))"
    return [messages.where(f"{number} % 3 <> 0"), messages.where(f"{number} % 3 = 0")]


def _refreshed(t: Tables, lake: lakes.Lake) -> None:
    """Cleaned events and what follows them after two batches and the expiry of the first three days."""
    spark, raw = t.spark, lake.table("events", "raw")

    def refresh() -> None:
        landed = lakes.landed_files(lakes.read_events(spark, lake))
        changed = history.changed_dates(spark, lake, landed)
        changes = history.apply_changes(spark, lake, changed)
        dates = (None, None) if changed is None else (changes.published, changes.happened)
        history.refresh_per_day(spark, lake, *dates)
        checks.check_history(spark, lake, history.CLEAN_EVENTS, history.CLEAN_SCHEMA)
        history.remember_refresh(spark, lake, landed)

    for batch in _two_batches(t):
        lakes.write_events(lake, batch)
        refresh()
    lakes.drop_partitions(spark, raw, lake.dates(spark, raw)[:3])
    refresh()


def events_daily_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity per event date, of which each refresh computed only the dates that changed."""
    lake = lakes.Lake(fresh_dir(spark, "per-day"))
    _refreshed(Tables(spark, sf_dir), lake)
    return history.per_day(spark, lake)


def events_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned events after late, moved and expired messages."""
    lake = lakes.Lake(fresh_dir(spark, "changes"))
    _refreshed(Tables(spark, sf_dir), lake)
    return history.clean_events(spark, lake).drop("dt")


def quality_report_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a table with repeated ids within and across dates, from a ledger of two checks."""
    lake = lakes.Lake(fresh_dir(spark, "ledger"))
    for batch in _two_batches(Tables(spark, sf_dir)):
        # copies are kept, so the check has something to find
        parsed = staging.parsed_events(batch).withColumn("dt", F.to_date("publish_time"))
        parsed.write.mode("append").partitionBy("dt").parquet(lake.table(history.CLEAN_EVENTS, "staging"))
        report = checks.check_history(spark, lake, history.CLEAN_EVENTS, history.CLEAN_SCHEMA)
    return report


def stream_merged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned events of a stream in several batches, without a horizon; the last batch comes twice."""
    t = Tables(spark, sf_dir)
    lake, folder = lakes.Lake(fresh_dir(spark, "merge")), fresh_dir(spark, "merge-messages")
    for run, batch in enumerate([*_two_batches(t), _two_batches(t)[1]]):
        batch.write.mode("append").parquet(folder)
        messages = streams.message_files(spark, folder, "parquet")
        streams.merge_stream(messages, lake, f"{lake.root}/checkpoint").awaitTermination()
    return streams.merged_events(spark, lake)


def live_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity per day of a stream whose second batch holds old events: those are late, and counted."""
    t = Tables(spark, sf_dir)
    lake, folder = lakes.Lake(fresh_dir(spark, "popularity")), fresh_dir(spark, "popular-messages")
    for batch in _two_batches(t):
        batch.write.mode("append").parquet(folder)
        messages = streams.message_files(spark, folder, "parquet")
        live.follow_popularity(messages, lake, f"{lake.root}/checkpoint", horizon="5 days").awaitTermination()
    return live.popularity(spark, lake)


def range_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and distinct users of two weeks, from stored sketches per day, and how well they place the lags.

    A quantile of a sketch is an estimate; what is compared is whether the share of lags up to it is
    within two percent of what was asked for.
    """
    events = _events(Tables(spark, sf_dir))
    path = fresh_dir(spark, "day-sketches")
    days = sketches.day_sketches(events)
    days.write.parquet(path)
    first, last = "2024-01-08", "2024-01-21"
    got = sketches.range_activity(spark.read.schema(days.schema).parquet(path), first, last)
    lags = with_lag(events).where(F.to_date("event_ts").between(first, last)).select(F.col("event_type").alias("kind"), "lag_us")
    placed = got.join(lags, F.col("event_type") == F.col("kind"))
    shares = {}
    for name, q in sketches.QUANTILES.items():
        below, upto = (F.avg((F.col("lag_us") < F.col(name)).cast("int")), F.avg((F.col("lag_us") <= F.col(name)).cast("int")))
        shares[name] = (below <= q + 0.02) & (upto >= q - 0.02)
    known = ["event_type", "events", "active_users", "touched_products"]
    return placed.groupBy(*known).agg(*[ok.alias(name.replace("_lag_us", "_ok")) for name, ok in shares.items()])


# -- lake ---------------------------------------------------------------------------------


def _land_snapshots(t: Tables, lake: lakes.Lake) -> None:
    def land(name: str) -> None:
        raw = getattr(t, name)()
        for day in (OLD_DAY, NEW_DAY):
            lakes.write_snapshot(lake, latest_snapshot(raw, day).drop("dt"), name, day)

    run_together(t.spark, {name: partial(land, name) for name in SNAPSHOTS})


def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dates loaded, the newer one twice: no duplicates, the older one untouched."""
    lake = lakes.Lake(fresh_dir(spark, "replace"))
    _land_snapshots(Tables(spark, sf_dir), lake)
    for day in (OLD_DAY, NEW_DAY, NEW_DAY):
        lakes.load_snapshot(spark, lake, "manufacturer", day)
    return lakes.read_raw(spark, lake, "manufacturer")


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each load reports, with the partition address, per table and date."""
    lake = lakes.Lake(fresh_dir(spark, "loads"))
    _land_snapshots(Tables(spark, sf_dir), lake)
    lines = []
    for day in (OLD_DAY, NEW_DAY):
        loaded = lakes.load_sources(spark, lake, day)
        loaded["products"] = lakes.load_snapshot(spark, lake, "products", day)
        lines += [(n, lakes.partition_address(n, day), r) for n, r in loaded.items()]
    return spark.createDataFrame(lines, "table_name string, address string, loaded_rows bigint")


def load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that all loads of a date report together."""
    lake = lakes.Lake(fresh_dir(spark, "totals"))
    _land_snapshots(Tables(spark, sf_dir), lake)
    totals = [
        (lakes.as_date(day), sum(lakes.load_sources(spark, lake, day).values())) for day in (OLD_DAY, NEW_DAY)
    ]
    return spark.createDataFrame(totals, "dt date, loaded_rows bigint")


def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging view read by SQL, over raw tables of two dates."""
    lake = lakes.Lake(fresh_dir(spark, "views"))
    _land_snapshots(Tables(spark, sf_dir), lake)
    for day in (OLD_DAY, NEW_DAY):
        lakes.load_sources(spark, lake, day)
        lakes.load_snapshot(spark, lake, "products", day)
    daily.staging_views(spark, lake)
    return spark.sql("select industry, permit_date, count(*) as companies from stg_manufacturer group by all")


def load_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer date holds an earlier delivery; a load whose audit fails leaves that in place."""
    t = Tables(spark, sf_dir)
    lake, raw = lakes.Lake(fresh_dir(spark, "audited")), t.manufacturer()
    earlier = latest_snapshot(raw, OLD_DAY).drop("dt")
    for day in (OLD_DAY, NEW_DAY):
        lakes.write_snapshot(lake, earlier, "manufacturer", day)
        lakes.load_snapshot(spark, lake, "manufacturer", day)
    lakes.write_snapshot(lake, latest_snapshot(raw, NEW_DAY).drop("dt"), "manufacturer", NEW_DAY)

    def only_traders(rows: DataFrame) -> None:
        enforce(quality_report({"manufacturer": rows}, [Check("manufacturer", "INDUTY", ACCEPTED, ("trade",))]))

    try:
        lakes.load_snapshot(spark, lake, "manufacturer", NEW_DAY, only_traders)
    except DataQualityError:
        return lakes.read_raw(spark, lake, "manufacturer")
    raise RuntimeError("the audit found nothing")


def refused_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty snapshot of each source is refused; the rows of the date that stand."""
    t = Tables(spark, sf_dir)
    lake, lines = lakes.Lake(fresh_dir(spark, "refused")), []
    _land_snapshots(t, lake)
    for name in SNAPSHOTS:
        refused = False
        try:
            lakes.write_snapshot(lake, getattr(t, name)().drop("dt").limit(0), name, NEW_DAY)
        except lakes.EmptySnapshotError:
            refused = True
        lines.append((name, refused, lakes.read_snapshot(spark, lake, name, NEW_DAY).count()))
    return spark.createDataFrame(lines, "table_name string, refused boolean, rows bigint")


def published_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart that readers see after one version replaced another and a third one failed its audit."""
    t = Tables(spark, sf_dir)
    lake, mart = lakes.Lake(fresh_dir(spark, "published")), _mart(t)
    per_day = marts.events_daily(_events(t))
    first = {"recommendations": analysis.dashboard_top(mart), "dashboard_events_daily": per_day.limit(1)}
    lakes.publish_tables(spark, lake, "marts", first)
    lakes.publish_tables(spark, lake, "marts", {"recommendations": mart, "dashboard_events_daily": per_day})

    def refuse(tables) -> None:
        raise DataQualityError("not good enough")

    try:
        lakes.publish_tables(spark, lake, "marts", first, audit=refuse)
    except DataQualityError:
        return daily.read_mart(spark, lake, "recommendations")
    raise RuntimeError("the audit was not asked")


def serve_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup on a published mart that is laid out by segment and rank."""
    lake = lakes.Lake(fresh_dir(spark, "clustered"))
    lakes.publish_tables(spark, lake, "marts", {"recommendations": _mart(Tables(spark, sf_dir))}, layouts=daily.LAYOUTS)
    return serving.recommend(daily.read_mart(spark, lake, "recommendations"), "sensitive", 20)


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API pages landed as a snapshot, loaded and read back, unknown fields included."""
    lake = lakes.Lake(fresh_dir(spark, "landed-pages"))
    pages.land_pages(lake, Tables(spark, sf_dir).company_pages(), "manufacturer", NEW_DAY)
    lakes.load_snapshot(spark, lake, "manufacturer", NEW_DAY)
    raw = spark.read.parquet(lake.table("manufacturer", "raw"))
    return raw.select("ENTP_SEQ", "ENTP_NAME", "rest", "dt")


def landed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot written as JSON lines and read back for one date."""
    lake = lakes.Lake(fresh_dir(spark, "jsonl"))
    raw = Tables(spark, sf_dir).ingredient()
    lakes.write_snapshot(lake, latest_snapshot(raw, NEW_DAY).drop("dt"), "ingredient", NEW_DAY)
    return lakes.read_snapshot(spark, lake, "ingredient", NEW_DAY)


def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compact partition address and rows per publication day."""
    messages = Tables(spark, sf_dir).raw_events()
    return messages.groupBy(partition_key(F.to_date("publish_time")).alias("partition_key")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def retention_expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expired partitions, with order dates and event dates as two partitioned tables."""
    t = Tables(spark, sf_dir)
    orders = t.read("orders").selectExpr("concat('orders_', o_orderstatus) as table_name", "to_date(o_orderdate) as dt")
    events = t.read("events").selectExpr("'events' as table_name", "to_date(ts) as dt")
    return lakes.retention(orders.unionAll(events).distinct(), "2024-04-20")


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole daily composition on a fresh lake; its recommendation mart."""
    t = Tables(spark, sf_dir)
    lake = lakes.Lake(fresh_dir(spark, "daily"))
    _land_snapshots(t, lake)
    lakes.write_events(lake, t.raw_events(dirty=False))
    return daily.run_daily(spark, lake, NEW_DAY, catalog=True).models["recommendations"]


def daily_run_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older day run again after a newer one, with the lists of its own date."""
    t = Tables(spark, sf_dir)
    lake = lakes.Lake(fresh_dir(spark, "as-of"))
    _land_snapshots(t, lake)
    lakes.write_events(lake, t.raw_events(dirty=False))
    daily.run_daily(spark, lake, OLD_DAY, catalog=True)
    daily.run_daily(spark, lake, NEW_DAY, catalog=True)
    return daily.run_daily(spark, lake, OLD_DAY, as_of=OLD_DAY).models["recommendations"]


def daily_run_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run from API pages that fails on a refused page, run again with good ones; its mart."""
    t = Tables(spark, sf_dir)
    lake = lakes.Lake(fresh_dir(spark, "resumed"))
    lakes.write_events(lake, t.raw_events(dirty=False))
    lakes.write_snapshot(lake, latest_snapshot(t.products(), NEW_DAY).drop("dt"), "products", NEW_DAY)
    path = fresh_dir(spark, "feeds")
    t.snapshot_pages().write.parquet(path)
    good = spark.read.parquet(path)
    refused = F.when(F.col("source") == "regulation", F.lit('{"header":{"resultCode":"22"}}')).otherwise(F.col("payload"))
    try:
        daily.run_daily(spark, lake, NEW_DAY, catalog=True, pages=good.withColumn("payload", refused))
    except daily.StageError:
        run = daily.run_daily(spark, lake, NEW_DAY, catalog=True, pages=good)
        if run.skipped != ("land ingredient", "land manufacturer"):
            raise RuntimeError(f"skipped {run.skipped}") from None
        return run.models["recommendations"]
    raise RuntimeError("the refused page was not noticed")


# -- API pages ----------------------------------------------------------------------------


def api_pages_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.unwrap_pages(Tables(spark, sf_dir).api_pages())
    return rows.selectExpr(
        "source", "page_no", "from_json(row_text, 'c_custkey bigint, c_name string') as r"
    ).select("source", "page_no", "r.*")


def api_page_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_errors(Tables(spark, sf_dir).api_pages())


def api_page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_completeness(Tables(spark, sf_dir).api_pages())


def api_pages_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of refused pages, and of pages that did not come: some are taken out of the feeds."""
    pages_left = Tables(spark, sf_dir).api_pages().where("page_no % 40 not between 16 and 27 or page_no % 40 = 20")
    return pages.missing_pages(pages_left)


QUERIES: dict[str, Query] = {
    "recommendations": recommendations,
    "product_risk": product_risk,
    "product_risk_split": product_risk_split,
    "recommendations_ranged": recommendations_ranged,
    "skin_product_scores": skin_product_scores,
    "stg_events": stg_events,
    "stg_ingredient": stg_ingredient,
    "stg_regulation": stg_regulation,
    "stg_regulation_pinned": stg_regulation_pinned,
    "stg_manufacturer": stg_manufacturer,
    "stg_products": stg_products,
    "latest_snapshot": latest_snapshot_rows,
    "events_daily": events_daily,
    "kpi_scorecard": kpi_scorecard,
    "regulated_origin": regulated_origin,
    "regulated_origin_report": regulated_origin_report,
    "serve_top_n": serve_top_n,
    "dashboard_top5": dashboard_top5,
    "top_scores_per_segment": top_scores_per_segment,
    "rank_in_segment": rank_in_segment,
    "catalog_names": catalog_names,
    "catalog_names_first": catalog_names_first,
    "topk_match_rate": topk_match_rate,
    "quality_report": quality,
    "quality_report_raw": quality_of_raw,
    "table_profile": table_profiles,
    "delivery_reconcile": delivery,
    "lost_events": lost_events,
    "arrival_lag": lag_by_type,
    "landed_messages": landed_messages,
    "stream_dedup_counts": stream_dedup_counts,
    "incremental_events": incremental_events,
    "incremental_scores": incremental_scores,
    "partition_replace": partition_replace,
    "load_counts": load_counts,
    "load_totals": load_totals,
    "staging_view": staging_view,
    "landed_pages": landed_pages,
    "landed_snapshot": landed_snapshot,
    "partition_keys": partition_keys,
    "retention_expired": retention_expired,
    "daily_run": daily_run,
    "daily_run_as_of": daily_run_as_of,
    "api_pages_unwrap": api_pages_unwrap,
    "api_page_errors": api_page_errors,
    "api_page_completeness": api_page_completeness,
    "api_pages_missing": api_pages_missing,
    "events_refreshed": events_refreshed,
    "events_daily_refreshed": events_daily_refreshed,
    "quality_report_history": quality_report_history,
    "stream_merged_events": stream_merged_events,
    "live_popularity": live_popularity,
    "load_audited": load_audited,
    "refused_snapshots": refused_snapshots,
    "published_marts": published_marts,
    "daily_run_resumed": daily_run_resumed,
    "range_activity": range_activity,
    "serve_published": serve_published,
}
