"""Tables that follow changed dates only: equal to a rebuild, minimal, and safe to break off."""

import datetime as dt
import os

import pytest
from conftest import plan_of
from test_daily import land_events, values
from test_staging import message, payload

from rankmill.operators.quality import CHECKS, quality_report
from rankmill.plans import checks, history, marts
from rankmill.plans.staging import stg_events
from rankmill.sources import lake as lakes
from rankmill.sources.schemas import EVENT_MESSAGE
from rankmill.streaming import events as streams
from rankmill.streaming import popularity as live
from workload import queries

HOUR, DAY = 3600, 86400


def event(name, at, happened=None, **fields):
    """A message published `at` seconds after the first one; it happened at noon of day `happened`."""
    if happened is not None:
        fields["event_ts"] = f"2026-07-{8 + happened:02d}T12:00:00+00:00"
    return message(payload(name, **fields), at)


def refresh(spark, lake):
    landed = lakes.landed_files(lakes.read_events(spark, lake))
    changed = history.changed_dates(spark, lake, landed)
    changes = history.apply_changes(spark, lake, changed)
    dates = (None, None) if changed is None else (changes.published, changes.happened)
    history.refresh_per_day(spark, lake, *dates)
    history.refresh_activity(spark, lake, dates=dates[0])
    report = checks.check_history(spark, lake, "stg_events", history.CLEAN_SCHEMA)
    history.remember_refresh(spark, lake, landed)
    return changes, report


def assert_equal_to_rebuild(spark, lake):
    expected = stg_events(lakes.read_events(spark, lake))
    clean = history.clean_events(spark, lake)
    assert values(clean.drop("dt")) == values(expected)
    assert values(history.per_day(spark, lake)) == values(marts.events_daily(expected))
    activity = spark.read.parquet(lake.table("segment_activity", "staging"))
    assert values(marts.scores_from_activity(activity)) == values(marts.skin_product_scores(expected))
    report = checks.check_history(spark, lake, "stg_events", history.CLEAN_SCHEMA)
    assert values(report) == values(quality_report({"stg_events": clean.drop("dt")}, CHECKS))


def files(lake, name):
    top = lake.table(name, "staging")
    return {os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.startswith("part-")}


def dates_of(paths):
    return {p.split("dt=")[1].split("/")[0] for p in paths}


def test_late_moved_and_expired_messages(spark, lake):
    land_events(spark, lake, [event(f"e{i}", i * DAY, i % 3) for i in range(6)] + [message("broken", DAY)])
    refresh(spark, lake)
    assert_equal_to_rebuild(spark, lake)
    # an earlier and a later copy, one of the same day, a new id, one that happened long before
    land_events(spark, lake, [event("e4", DAY + 5, 1), event("e0", 3 * DAY, 2), event("e1", DAY - HOUR, 1),
                              event("n1", 2 * DAY, 5), event("n2", 5 * DAY, 0), event("e2", 2 * DAY + 1, 4)])
    changes, _ = refresh(spark, lake)
    assert_equal_to_rebuild(spark, lake)
    # the dates that hold the moved events' first copies go, and their next copies take their place
    raw = lake.table("events", "raw")
    lakes.drop_partitions(spark, raw, lake.dates(spark, raw)[:2])
    refresh(spark, lake)
    assert_equal_to_rebuild(spark, lake)
    assert "e0" in {r.event_id for r in history.clean_events(spark, lake).collect()}
    refresh(spark, lake)
    assert_equal_to_rebuild(spark, lake)


def test_messages_without_a_publication_time(spark, lake):
    timeless = ("s", "m", None, message(payload("e1", event_type="like"))[3], None)
    land_events(spark, lake, [event(f"e{i}", i * DAY, i) for i in range(3)])
    refresh(spark, lake)
    land_events(spark, lake, [timeless, message(payload("bad", event_ts="soon"), DAY)])
    changes, _ = refresh(spark, lake)
    assert_equal_to_rebuild(spark, lake)
    assert None in changes.published and None in changes.happened


def test_one_late_file_rewrites_its_dates_only(spark, lake):
    land_events(spark, lake, [event(f"e{i}", i * DAY, i) for i in range(8)])
    refresh(spark, lake)
    before = {n: files(lake, n) for n in ("stg_events", "events_per_day", "segment_activity", "event_feeds")}
    # e5 turns out to be published a day earlier; the rest of the file says nothing new
    land_events(spark, lake, [event("e5", 4 * DAY + 9, 5), event("e4", 4 * DAY + 10, 4)])
    changes, _ = refresh(spark, lake)
    assert changes.published == {dt.date(2026, 7, 12), dt.date(2026, 7, 13)}
    assert changes.happened == {dt.date(2026, 7, 13)}
    for name, old in before.items():
        touched = dates_of(old ^ files(lake, name))
        assert touched <= {"2026-07-12", "2026-07-13"} and "2026-07-13" in touched
    assert dates_of(before["events_per_day"] ^ files(lake, "events_per_day")) == {"2026-07-13"}
    assert_equal_to_rebuild(spark, lake)
    untouched = {n: files(lake, n) for n in before}
    land_events(spark, lake, [event("e7", 7 * DAY + 60, 7)])
    assert refresh(spark, lake)[0] == history.Changes(set(), set())
    assert {n: files(lake, n) for n in before} == untouched


def test_only_partitions_that_feed_an_event_date_are_read(spark, lake):
    land_events(spark, lake, [event(f"e{i}", i * DAY, i // 3) for i in range(9)])
    refresh(spark, lake)
    feeds = spark.read.schema(history.FEEDS_SCHEMA).parquet(lake.table("event_feeds", "staging"))
    day = dt.date(2026, 7, 9)
    assert history.feeding_dates(feeds, {day}) == {dt.date(2026, 7, 11 + k) for k in range(3)}
    events = history.events_of_days(spark, lake, feeds, {day})
    assert {r.event_id for r in events.collect()} == {"e3", "e4", "e5"}
    plan = plan_of(events)
    assert "PartitionFilters: [" in plan and "2026-07-11" in plan and "2026-07-08" not in plan.split("PartitionFilters")[1].split("]")[0]


@pytest.mark.parametrize("broken", ["stg_events", "stg_events_repeats"])
def test_a_refresh_that_breaks_off_is_made_good(spark, lake, monkeypatch, broken):
    land_events(spark, lake, [event(f"e{i}", i * DAY, i) for i in range(4)])
    refresh(spark, lake)
    land_events(spark, lake, [event("e3", DAY, 3), event("e0", 2 * DAY, 0), event("n", 2 * DAY + 1, 2)])
    whole = history.replace_dates

    def fails(df, path, dates):
        if path.endswith(broken):
            raise OSError("disk gone")
        whole(df, path, dates)

    monkeypatch.setattr(history, "replace_dates", fails)
    with pytest.raises(OSError):
        refresh(spark, lake)
    monkeypatch.setattr(history, "replace_dates", whole)
    # the next message removes the copy that the broken refresh had moved to
    raw = lake.table("events", "raw")
    lakes.drop_partitions(spark, raw, [dt.date(2026, 7, 9)])
    refresh(spark, lake)
    assert_equal_to_rebuild(spark, lake)


def test_derived_tables_follow_a_refresh_that_was_not_remembered(spark, lake):
    land_events(spark, lake, [event(f"e{i}", i * DAY, i) for i in range(4)])
    refresh(spark, lake)
    land_events(spark, lake, [event("late", DAY, 0)])
    landed = lakes.landed_files(lakes.read_events(spark, lake))
    history.apply_changes(spark, lake, history.changed_dates(spark, lake, landed))
    assert history.pending_changes(spark, lake).happened == {dt.date(2026, 7, 8)}
    refresh(spark, lake)
    assert_equal_to_rebuild(spark, lake)
    assert history.pending_changes(spark, lake) == history.Changes(set(), set())


# -- check ledger -------------------------------------------------------------------------


def put(spark, lake, rows, mode="append"):
    clean = stg_events(spark.createDataFrame(rows, EVENT_MESSAGE)).selectExpr("*", "to_date(publish_time) as dt")
    clean.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(lake.table("stg_events", "staging"))


def checked(spark, lake):
    report = checks.check_history(spark, lake, "stg_events", history.CLEAN_SCHEMA)
    table = spark.read.schema(history.CLEAN_SCHEMA).parquet(lake.table("stg_events", "staging"))
    assert values(report) == values(quality_report({"stg_events": table.drop("dt")}, CHECKS))
    return {r.check_name: r.violations for r in report.collect()}


def test_the_ledger_finds_and_forgets_repeated_ids(spark, lake):
    put(spark, lake, [event(f"e{i}", i * DAY) for i in range(3)])
    assert checked(spark, lake) == {"not_null": 0, "unique": 0, "accepted_values": 0}
    # e0 once more on another date, and a type that is not known
    put(spark, lake, [event("e0", 4 * DAY), event("x", 4 * DAY, event_type="share")])
    assert checked(spark, lake) == {"not_null": 0, "unique": 1, "accepted_values": 1}
    assert [r.key for r in checks.repeated_keys(spark, lake, "stg_events").collect()] == ["e0"]
    put(spark, lake, [event("e1", 5 * DAY), event("e0", 5 * DAY)])
    assert checked(spark, lake)["unique"] == 2
    # the first date is written again without e0: two copies are left; then one
    put(spark, lake, [event("other", 0)], "overwrite")
    assert checked(spark, lake)["unique"] == 2
    lakes.drop_partitions(spark, lake.table("stg_events", "staging"), [dt.date(2026, 7, 13)])
    assert checked(spark, lake) == {"not_null": 0, "unique": 0, "accepted_values": 1}
    assert checks.check_ledger(spark, lake, "stg_events").count() == 4


def test_only_changed_dates_are_counted_again(spark, lake, monkeypatch):
    put(spark, lake, [event(f"e{i}", i * DAY) for i in range(5)])
    checked(spark, lake)
    put(spark, lake, [event("n", 2 * DAY)])
    asked = []
    monkeypatch.setattr(checks, "in_dates", lambda dates, *a: asked.append(set(dates)) or lakes.in_dates(dates, *a))
    checked(spark, lake)
    assert asked[0] == {dt.date(2026, 7, 10)} and len(asked[-1]) == 4
    asked.clear()
    checked(spark, lake)
    assert asked == []


# -- streams ------------------------------------------------------------------------------


def feed(spark, folder, rows):
    spark.createDataFrame(rows, EVENT_MESSAGE).coalesce(1).write.mode("append").parquet(folder)
    return streams.message_files(spark, folder, "parquet")


def test_stream_copies_months_apart_and_a_replayed_batch(spark, lake, tmp_path):
    folder, point = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    rows = [event(f"e{i}", i * DAY) for i in range(4)]
    late = [event("e3", 200 * DAY), event("e0", -90 * DAY), event("n", DAY), event("e1", DAY + 5)]
    for batch in (rows, late):
        streams.merge_stream(feed(spark, folder, batch), lake, point).awaitTermination()
    expected = values(stg_events(spark.createDataFrame(rows + late, EVENT_MESSAGE)))
    assert values(streams.merged_events(spark, lake)) == expected
    before = files(lake, "merged_events")
    # the same messages in another batch, and the same batch by a new query
    streams.merge_stream(feed(spark, folder, late), lake, point).awaitTermination()
    streams.merge_stream(streams.message_files(spark, folder, "parquet"), lake, str(tmp_path / "again")).awaitTermination()
    assert values(streams.merged_events(spark, lake)) == expected and files(lake, "merged_events") == before


def test_late_rows_of_the_popularity_are_counted_and_kept(spark, lake, tmp_path):
    folder, point = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    first = [event(f"e{i}", i * DAY, i) for i in range(4)] + [message(payload("bad", event_ts="soon"), 0), message("broken", 0)]
    second = [event("old", 4 * DAY, 0), event("edge", 4 * DAY, 2), event("e3", 4 * DAY, 3), event("new", 5 * DAY, 5)]
    for batch in (first, second):
        live.follow_popularity(feed(spark, folder, batch), lake, point, horizon="1 day").awaitTermination()
    assert live.progress(spark, lake) == {"rows": 9, "late": 1, "untimed": 1}
    assert [(r.event_id, r.batch) for r in live.late_events(spark, lake).collect()] == [("old", 1)]
    got = {str(r.window_start)[:10]: (r.events, r.late_rows) for r in live.popularity(spark, lake).collect()}
    assert got == {"2026-07-08": (1, 1), "2026-07-09": (1, 0), "2026-07-10": (2, 0), "2026-07-11": (1, 0), "2026-07-13": (1, 0)}


def test_no_task_writes_a_whole_batch_of_the_merged_stream(spark, sf_dir, monkeypatch):
    found, follow = [], streams.message_files

    def message_files(spark, folder, *args):
        found.append(sum(name.endswith(".parquet") for name in os.listdir(folder)))
        return follow(spark, folder, *args)

    monkeypatch.setattr(streams, "message_files", message_files)
    queries.stream_merged_events(spark, sf_dir)
    assert [after - before > 1 for before, after in zip([0, *found], found)] == [True] * 3
