"""What is derived from all events, kept up to date by the dates that changed.

Tables in the staging layer, partitioned by publication date unless said otherwise:

    stg_events          one row per event id: the copy published first
    stg_events_repeats  of every other date that holds a copy, its first one
    event_feeds         publication date -> event dates its rows of `stg_events` belong to
    segment_activity    additive counts per day, segment and product
    events_per_day      activity per event date (that is its partition) and event type

The first two hold together what each date's own messages say, so a date can lose a copy and the next
one is at hand without parsing other messages again. A refresh parses the changed dates once, compares
the result with what the tables hold for them, and takes the ids that differ: the change set. Only
dates with a row in it are written again, and only event dates of such rows are computed again.

Two notes make a broken refresh harmless. `event_refresh` lists the files that the tables cover, per
date. `event_changes` lists dates that are being written and dates whose derived tables are still to
follow; a later refresh takes the first ones from their messages again and passes the others on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankmill.operators.dedup import first_per_key, remaining_order
from rankmill.plans.marts import daily_activity, events_daily
from rankmill.plans.staging import parsed_events
from rankmill.session import fresh_dir, run_together, use_utc
from rankmill.sources.lake import (
    EmptySnapshotError,
    Lake,
    as_date,
    event_dates,
    event_tables,
    held_dates,
    in_dates,
    read_events,
    replace_dates,
)
from rankmill.sources.notes import read_note, write_note

STAGING = "staging"
CLEAN_EVENTS, REPEATS = "stg_events", "stg_events_repeats"
FEEDS, ACTIVITY, PER_DAY = "event_feeds", "segment_activity", "events_per_day"
REFRESHED, CHANGES = "event_refresh", "event_changes"

# Columns of the cleaned event table, of its index and of the activity per day.
CLEAN_SCHEMA = (
    "event_id string, event_type string, event_ts timestamp, user_id string, skin_type string, "
    "product_id string, session_id string, rating bigint, publish_time timestamp, dt date"
)
FEEDS_SCHEMA = "event_date date, events bigint, dt date"
PER_DAY_SCHEMA = (
    "event_date date, event_type string, events bigint, active_users bigint, touched_products bigint, "
    "avg_rating double, dt date"
)

Dates = set[dt.date | None]


@dataclass(frozen=True)
class Changes:
    """Dates of `stg_events` that were written again, and event dates of rows that came, went or changed."""

    published: Dates
    happened: Dates


def _texts(dates: Iterable[dt.date | None]) -> list[str]:
    return sorted("" if d is None else d.isoformat() for d in dates)


def _dates(texts: Iterable[str]) -> Dates:
    return {as_date(t) if t else None for t in texts}


def _table(spark: SparkSession, lake: Lake, name: str, schema: str) -> DataFrame:
    """A table with its fixed schema, empty if it was never written."""
    path = lake.table(name, STAGING)
    if not held_dates(spark, lake, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def clean_events(spark: SparkSession, lake: Lake) -> DataFrame:
    return _table(spark, lake, CLEAN_EVENTS, CLEAN_SCHEMA)


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _column_dates(df: DataFrame, column: str = "dt") -> Dates:
    """The different dates of a column: as many as there are days."""
    return {r[0] for r in df.select(column).distinct().collect()}


# -- what changed -------------------------------------------------------------------------


def _pending(spark: SparkSession, lake: Lake) -> dict[str, Dates]:
    note = read_note(spark, lake.table(CHANGES, STAGING)) or {}
    return {key: _dates(note.get(key, [])) for key in ("torn", "published", "happened")}


def _note_pending(spark: SparkSession, lake: Lake, **dates: Dates) -> None:
    write_note(spark, lake.table(CHANGES, STAGING), {key: _texts(value) for key, value in dates.items()})


def covered_files(spark: SparkSession, lake: Lake) -> dict[dt.date, str] | None:
    """Per publication date the digest of the files that the derived tables cover."""
    note = read_note(spark, lake.table(REFRESHED, STAGING))
    return {as_date(day): digest for day, digest in note["files"].items()} if note else None


def changed_dates(spark: SparkSession, lake: Lake, landed: dict[dt.date, str]) -> set[dt.date] | None:
    """Publication dates whose files differ from those the tables cover; None asks for a rebuild."""
    seen = covered_files(spark, lake)
    if seen is None:
        return None
    return {day for day in landed.keys() | seen.keys() if landed.get(day) != seen.get(day)}


def remember_refresh(spark: SparkSession, lake: Lake, landed: dict[dt.date, str]) -> None:
    """Note that every derived table follows the given files."""
    write_note(spark, lake.table(REFRESHED, STAGING), {"files": {d.isoformat(): f for d, f in landed.items()}})
    _note_pending(spark, lake, torn=set(), published=set(), happened=set())


def pending_changes(spark: SparkSession, lake: Lake) -> Changes:
    """What the derived tables still have to follow."""
    pending = _pending(spark, lake)
    return Changes(pending["published"], pending["happened"])


# -- cleaned events -----------------------------------------------------------------------


# The id comes first in every key: sorts compare the first bytes of their first column before all else,
# and a date or a flag tells hardly any rows apart.
KEY = ["event_id", "dt", "repeat"]
COPY = ["event_id", "dt"]


def _marked(clean: DataFrame, repeats: DataFrame) -> DataFrame:
    """The rows of both tables; `repeat` tells which one."""
    return clean.withColumn("repeat", F.lit(0)).unionByName(repeats.withColumn("repeat", F.lit(1)))


def _content(marked: DataFrame) -> DataFrame:
    """(event_id, dt, repeat, row); the first three are a key."""
    return marked.select(*KEY, F.struct(*[c for c in marked.columns if c not in KEY]).alias("row"))


def _differences(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """The key and both rows, `new` and `old`, where they differ or one is missing."""
    none = F.lit(None).cast(new.schema["row"].dataType)
    if old is None:
        return new.select(*KEY, F.col("row").alias("new"), none.alias("old"))
    sides = new.select(*KEY, F.col("row").alias("new"), none.alias("old")).unionAll(
        old.select(*KEY, none.alias("new"), F.col("row").alias("old"))
    )
    # each side has a key once, so there is nothing to combine before the exchange; max passes over the
    # side that has no row
    both = sides.repartition(*KEY).groupBy(*KEY).agg(F.max("new").alias("new"), F.max("old").alias("old"))
    return both.where(~F.col("new").eqNullSafe(F.col("old")))


def _moved(differences: DataFrame) -> tuple[Dates, Dates, Dates]:
    """Dates of either table with a difference, and event dates of the rows that differ in the first.

    One row of sets that are as large as there are days.
    """

    def dates_of(column: Column, rows: Column) -> Column:
        return F.collect_set(F.when(rows, F.struct(column.alias("d"))))

    clean = F.col("repeat") == 0
    sides = [(F.col(side), F.to_date(f"{side}.event_ts")) for side in ("new", "old")]
    found = differences.agg(
        dates_of(F.col("dt"), clean),
        dates_of(F.col("dt"), ~clean),
        *[dates_of(date, clean & side.isNotNull()) for side, date in sides],
    ).head()
    published, repeated, came, went = ({r["d"] for r in part} for part in found)
    return published, repeated, came | went


def _order(events: DataFrame) -> list:
    return [F.col("publish_time").asc_nulls_first(), *remaining_order(events, ["event_id", "publish_time", "dt"])]


@dataclass(frozen=True)
class Tables:
    """Names of a table of cleaned events and of its repeated copies."""

    clean: str = CLEAN_EVENTS
    repeats: str = REPEATS

    def read(self, spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
        return _table(spark, lake, self.clean, CLEAN_SCHEMA), _table(spark, lake, self.repeats, CLEAN_SCHEMA)


def _settle(
    spark: SparkSession,
    lake: Lake,
    tables: Tables,
    copies: DataFrame,
    affected: DataFrame | None,
    before: DataFrame | None,
    pending: dict[str, Dates],
) -> Changes:
    """Write both tables so that the first of the copies of each affected id counts.

    `copies` has all copies of the affected ids, one per date; `before` the marked rows that the tables
    hold of them, None if there are no tables yet. Without `affected` every id is. Only dates with a row
    that differs are written.
    """
    clean, repeats = tables.read(spark, lake)
    # a date holds an id once, so all but the first row of an id are of other dates; dates follow the
    # time of publication, and with them in front rows that come sorted by copy need no other sort
    place = F.row_number().over(Window.partitionBy("event_id").orderBy(F.col("dt").asc_nulls_first(), *_order(copies)))
    ranked = _kept(copies.withColumn("repeat", (place > 1).cast("int")), "ranked-copies")
    first, repeated = (ranked.where(f"repeat = {n}").drop("repeat") for n in (0, 1))

    old = _content(before) if before is not None else None
    published, repeats_changed, happened = _moved(_differences(_content(ranked), old))

    published_all, happened_all = published | pending["published"], happened | pending["happened"]
    own = tables == Tables()
    if own:
        torn = published | repeats_changed | pending["torn"]
        _note_pending(spark, lake, torn=torn, published=published_all, happened=happened_all)

    def written(table: DataFrame, new: DataFrame, changed: Dates, name: str) -> None:
        if changed:
            stay = table.where(in_dates(changed))
            stay = stay.join(affected, "event_id", "left_anti") if affected is not None else stay.limit(0)
            replace_dates(stay.unionByName(new.where(in_dates(changed))), lake.table(name, STAGING), changed)

    run_together(
        spark,
        {
            tables.repeats: lambda: written(repeats, repeated, repeats_changed, tables.repeats),
            tables.clean: lambda: written(clean, first, published, tables.clean),
        },
    )
    if own:
        _note_pending(spark, lake, torn=set(), published=published_all, happened=happened_all)
    return Changes(published_all, happened_all)


def merge_parsed(spark: SparkSession, lake: Lake, parsed: DataFrame, tables: Tables) -> Changes:
    """Add parsed events to a table of cleaned ones; copies of held events count, however old those are.

    Adding the same events again changes nothing, so a repeated delivery of a batch is harmless.
    """
    use_utc(spark)
    parsed = parsed.withColumn("dt", F.to_date("publish_time"))
    fresh = _kept(first_per_key(parsed, COPY, _order(parsed)), "merged-events")
    affected = _kept(fresh.select("event_id").distinct(), "merged-ids")
    held = _held(_marked(*tables.read(spark, lake)), affected, set())
    # an id has a row per date and side at most, so it can go to one task without being trimmed first
    copies = fresh.unionByName(held.drop("repeat")).repartition("event_id")
    one_a_date = first_per_key(copies, COPY, _order(copies))
    return _settle(spark, lake, tables, one_a_date, affected, held, dict.fromkeys(("torn", "published", "happened"), set()))


def _held(marked: DataFrame, affected: DataFrame, dates: Dates) -> DataFrame:
    """The marked rows of affected ids, kept: of the given dates, and of the others that hold such an id.

    Of the others first the id column is read, then whole rows of the dates that hold such an id.
    """
    others = marked.where(~F.coalesce(in_dates(dates), F.lit(False)))
    near = _column_dates(others.select(*COPY).join(affected, "event_id", "left_semi"))
    return _kept(marked.where(in_dates(dates | near)).join(affected, "event_id", "left_semi"), "held-copies")


def apply_changes(spark: SparkSession, lake: Lake, changed: Collection[dt.date | None] | None = None) -> Changes:
    """Bring the cleaned events up to date with the messages of the changed publication dates.

    None stands for all dates. Dates whose messages are gone from the raw tables always count as
    changed, and so do messages without a publication time. The result equals a rebuild from all messages.
    It is refused when no landed message is found while there are cleaned events.
    """
    use_utc(spark)
    landed = set(event_dates(spark, lake))
    held = set().union(*[held_dates(spark, lake, lake.table(name, STAGING)) for name in (CLEAN_EVENTS, REPEATS)])
    if held and not landed and not any(None in held_dates(spark, lake, p) for p in event_tables(lake)):
        raise EmptySnapshotError(
            f"no landed events below {' or '.join(event_tables(lake))}; the cleaned table stays as it is"
        )
    pending = _pending(spark, lake)
    known = held - {None}
    todo = {None} | (known - landed) | pending["torn"] | (landed | known if changed is None else set(changed))
    rest = known - todo

    messages = read_events(spark, lake, dates=todo & landed)
    parsed = parsed_events(messages).withColumn("dt", F.to_date("publish_time"))
    fresh = first_per_key(parsed, COPY, _order(parsed))
    marked = _marked(*Tables().read(spark, lake))
    affected, copies, before = None, fresh, marked.where(in_dates(todo)) if held else None
    if rest:
        fresh = _kept(fresh, "fresh-events")
        of_todo = marked.where(in_dates(todo))
        as_one = [_content(part.withColumn("repeat", F.lit(0))) for part in (fresh, of_todo)]
        differing = _differences(*as_one).select("event_id")
        if pending["torn"]:
            # what a broken refresh left there proves nothing about other dates
            torn = in_dates(pending["torn"])
            differing = differing.unionAll(fresh.where(torn).select("event_id"))
            differing = differing.unionAll(of_todo.where(torn).select("event_id"))
        affected = _kept(differing.distinct(), "changed-ids")
        if affected.isEmpty() and not pending["torn"]:
            return Changes(pending["published"], pending["happened"])
        before = _held(marked, affected, todo)
        others = before.where(~in_dates(todo)).drop("repeat")
        copies = fresh.join(affected, "event_id", "left_semi").unionByName(others)
    return _settle(spark, lake, Tables(), copies, affected, before, pending)


def refresh_events(
    spark: SparkSession,
    lake: Lake,
    since: dt.date | str | None = None,
    changed: Collection[dt.date | None] | None = None,
) -> DataFrame:
    """The cleaned events after the messages of the given dates, or from `since` on, were taken in.

    Without either, or without a table, all messages are. The result equals a full rebuild as long as the
    dates include those that received or lost messages since the last refresh; `changed_dates` finds them.
    """
    if changed is None and since is not None and held_dates(spark, lake, lake.table(CLEAN_EVENTS, STAGING)):
        changed = {day for day in event_dates(spark, lake) if day >= as_date(since)}
    apply_changes(spark, lake, changed)
    return clean_events(spark, lake).drop("dt")


# -- tables derived from the cleaned events -----------------------------------------------


def refresh_activity(
    spark: SparkSession,
    lake: Lake,
    since: dt.date | str | None = None,
    dates: Collection[dt.date | None] | None = None,
) -> DataFrame:
    """Daily sums per segment and product, computed again for the given cleaned dates, or from `since` on.

    Other days keep their sums, so the scores of all history cost a scan of the changed days
    and of these sums.
    """
    clean, path = lake.table(CLEAN_EVENTS, STAGING), lake.table(ACTIVITY, STAGING)
    days, old = held_dates(spark, lake, clean), held_dates(spark, lake, path)
    if old and not days:
        raise EmptySnapshotError(f"no cleaned events below {clean}; the daily sums stay as they are")
    todo: Dates = days | old
    if old and dates is not None:
        todo = set(dates) | (old ^ days)
    elif old and since is not None:
        todo = {d for d in todo if d is None or d >= as_date(since)} | (old ^ days)
    activity = daily_activity(clean_events(spark, lake).where(in_dates(todo)))
    if todo:
        replace_dates(activity, path, todo)
    return spark.read.schema(activity.schema).parquet(path)


def refresh_feeds(spark: SparkSession, lake: Lake, published: Collection[dt.date | None] | None = None) -> DataFrame:
    """The index from publication dates to event dates, for the given dates of `stg_events` or for all."""
    clean, path = lake.table(CLEAN_EVENTS, STAGING), lake.table(FEEDS, STAGING)
    days, old = held_dates(spark, lake, clean), held_dates(spark, lake, path)
    todo = (set(published) if published is not None else days | old) | (old ^ days)
    events = clean_events(spark, lake).where(in_dates(todo))
    feeds = events.groupBy("dt", F.to_date("event_ts").alias("event_date")).agg(F.count(F.lit(1)).alias("events"))
    if todo:
        replace_dates(feeds.select("event_date", "events", "dt"), path, todo)
    return _table(spark, lake, FEEDS, FEEDS_SCHEMA)


def feeding_dates(feeds: DataFrame, happened: Collection[dt.date | None]) -> Dates:
    """Publication dates whose rows belong to one of the given event dates."""
    return _column_dates(feeds.where(in_dates(happened, "event_date")))


def events_of_days(spark: SparkSession, lake: Lake, feeds: DataFrame, happened: Collection[dt.date | None]) -> DataFrame:
    """The cleaned events of the given event dates, from the partitions that feed them."""
    events = clean_events(spark, lake).where(in_dates(feeding_dates(feeds, happened)))
    dated = events.withColumn("event_date", F.to_date("event_ts"))
    return dated.where(in_dates(happened, "event_date")).drop("event_date")


def refresh_per_day(
    spark: SparkSession,
    lake: Lake,
    published: Collection[dt.date | None] | None = None,
    happened: Collection[dt.date | None] | None = None,
) -> DataFrame:
    """Activity per event date and type, computed again for the event dates in `happened`, or for all.

    The index tells which partitions of the cleaned events feed them, so no other partition is read.
    Equals `events_daily` over all cleaned events.
    """
    path = lake.table(PER_DAY, STAGING)
    old = held_dates(spark, lake, path)

    def replaced(events: DataFrame, dates: Dates) -> None:
        replace_dates(events_daily(events).withColumn("dt", F.col("event_date")), path, dates)

    if happened is not None and old:
        feeds = refresh_feeds(spark, lake, published)
        if happened:
            replaced(events_of_days(spark, lake, feeds, happened), set(happened))
    else:
        run_together(
            spark,
            {
                FEEDS: lambda: refresh_feeds(spark, lake, published),
                PER_DAY: lambda: replaced(clean_events(spark, lake), old),
            },
        )
    return per_day(spark, lake)


def per_day(spark: SparkSession, lake: Lake) -> DataFrame:
    return _table(spark, lake, PER_DAY, PER_DAY_SCHEMA).drop("dt")
