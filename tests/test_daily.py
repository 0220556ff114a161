import json
import os

import pytest
from test_staging import message, payload

from rankmill.operators.quality import DataQualityError
from rankmill.plans import daily, marts
from rankmill.plans.serving import lookup
from rankmill.plans.staging import stg_events
from rankmill.sources import lake as lakes
from rankmill.sources.schemas import EVENT_MESSAGE, INGREDIENT, MANUFACTURER, PRODUCTS, REGULATION

DAY, NEXT = "2026-07-07", "2026-07-08"


def land_day(spark, lake, day, catalog=True):
    def put(source, schema, rows):
        lakes.write_snapshot(lake, spark.createDataFrame(rows, schema), source, day)

    put("ingredient", INGREDIENT, [("water", "Water", None, None, "plant")])
    put("regulation", REGULATION, [("banned", "B", "EU", None)])
    put("manufacturer", MANUFACTURER, [("1", "n", "b", "i", "f", "12", "20260703")] * 2)
    if catalog:
        put("products", PRODUCTS, [("p1", "n1", "c", "dry", 1000, ["water"]), ("p2", "n2", "c", "all", 900, ["banned"])])


def land_events(spark, lake, rows):
    lakes.write_events(lake, spark.createDataFrame(rows, EVENT_MESSAGE))


def values(df):
    return sorted(map(str, df.collect()))


def test_a_day_end_to_end_and_again(spark, lake):
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload("a")), message(payload("a"), 9), message(payload("b", product_id="p2"))])
    first = daily.run_daily(spark, lake, DAY, catalog=True)
    assert first.loaded == {"ingredient": 1, "regulation": 1, "manufacturer": 2, "products": 2}
    assert first.total_rows == 6
    assert first.report.count() == 17
    assert [r.product_id for r in lookup(first.models["recommendations"], "dry")] == ["p1"]
    before = {n: values(m) for n, m in first.models.items()}
    again = daily.run_daily(spark, lake, DAY, catalog=True)
    assert {n: values(m) for n, m in again.models.items()} == before
    assert spark.table("stg_products").count() == 2


def test_a_later_day_uses_its_own_lists_and_the_standing_catalog(spark, lake):
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload("a")), message(payload("b", product_id="p2"))])
    daily.run_daily(spark, lake, DAY, catalog=True)
    land_day(spark, lake, NEXT, catalog=False)
    lakes.write_snapshot(lake, spark.createDataFrame([("other", "O", "EU", None)], REGULATION), "regulation", NEXT)
    run = daily.run_daily(spark, lake, NEXT)
    assert [r.product_id for r in lookup(run.models["recommendations"], "dry")] == ["p1", "p2"]


def test_violations_stop_the_run(spark, lake):
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload("a", event_type="share"))])
    with pytest.raises(DataQualityError, match="event_type"):
        daily.run_daily(spark, lake, DAY, catalog=True)
    assert daily.run_daily(spark, lake, DAY, check=False).report.where("violations > 0").count() == 2


def test_a_missing_source_stops_the_run_before_the_models(spark, lake):
    land_day(spark, lake, DAY)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        daily.run_daily(spark, lake, "2026-01-01", catalog=True)
    assert lake.dates(spark, lake.table("stg_events", "staging")) == []


def test_origin_report_from_landed_snapshots(spark, lake, capsys):
    land_day(spark, lake, DAY)
    lakes.write_snapshot(lake, spark.createDataFrame([("water", "W", None, "KR"), ("water", "W", "EU", None)], REGULATION),
                         "regulation", DAY)
    out = daily.regulated_origin_report(spark, lake, DAY, preview=20)
    assert [tuple(r) for r in out.collect()] == [("plant", 1, 0.5)]
    assert "plant" in capsys.readouterr().out
    assert out.inputFiles()[0].split("/")[-2] == f"dt={DAY}"


def test_refresh_equals_rebuild(spark, lake):
    day = 86400
    land_events(spark, lake, [message(payload(f"e{i}"), i * day) for i in range(4)])
    daily.refresh_events(spark, lake)
    # copies of old ids and new ids arrive on later days
    land_events(spark, lake, [message(payload("e0"), 2 * day + 5), message(payload("n1"), 2 * day + 6),
                              message(payload("n1"), 3 * day), message(payload("e3"), 3 * day + 9),
                              message("broken", 3 * day), message(payload("n2"), 6 * day)])
    part = values(daily.refresh_events(spark, lake, since="2026-07-10"))
    full = values(stg_events(lakes.read_events(spark, lake)))
    assert part == full and len(part) == 6
    assert values(daily.refresh_events(spark, lake, since="2026-07-10")) == full
    assert values(daily.refresh_events(spark, lake)) == full


@pytest.mark.parametrize("since", ["2026-07-09", None])
def test_a_late_copy_can_empty_a_later_day(spark, lake, since):
    day = 86400
    land_events(spark, lake, [message(payload("old"), 0), message(payload("x"), 3 * day), message(payload("y"), 4 * day)])
    daily.refresh_events(spark, lake)
    daily.refresh_activity(spark, lake)
    land_events(spark, lake, [message(payload("x"), 1 * day)])
    out = values(daily.refresh_events(spark, lake, since=since))
    assert out == values(stg_events(lakes.read_events(spark, lake))) and len(out) == 3
    dates = [str(d) for d in lake.dates(spark, lake.table("stg_events", "staging"))]
    assert dates == ["2026-07-08", "2026-07-09", "2026-07-12"]
    scores = marts.scores_from_activity(daily.refresh_activity(spark, lake, since=since)).first()
    assert scores.views == 3


def test_scores_from_refreshed_daily_sums_equal_a_rebuild(spark, lake):
    day = 86400
    land_events(spark, lake, [message(payload(f"e{i}", rating=i % 5 + 1, event_type="rating"), i * day) for i in range(4)]
                + [("s", "m", None, json.dumps(payload("timeless", event_type="like")), None)])
    daily.refresh_events(spark, lake)
    daily.refresh_activity(spark, lake)
    land_events(spark, lake, [message(payload("e0"), 3 * day), message(payload("n1", event_type="purchase"), 3 * day),
                              message(payload("n2", skin_type=None, product_id="p9"), 5 * day)])
    events = daily.refresh_events(spark, lake, since="2026-07-11")
    part = daily.refresh_activity(spark, lake, since="2026-07-11")
    assert values(marts.scores_from_activity(part)) == values(marts.skin_product_scores(events))
    rows = {(r.skin_type, r.product_id): r for r in marts.scores_from_activity(part).collect()}
    assert values(part) == values(daily.refresh_activity(spark, lake))
    assert rows[("dry", "p1")].score == 5 + 3 + 2 * 2.5
    assert rows[(None, "p9")].avg_rating is None


def test_refresh_drops_partitions_whose_messages_expired(spark, lake):
    day = 86400
    land_events(spark, lake, [message(payload(f"e{i}"), i * day) for i in range(3)])
    daily.refresh_events(spark, lake)
    raw = lake.table("events", "raw")
    lakes.drop_partitions(spark, raw, lake.dates(spark, raw)[:1])
    assert daily.refresh_events(spark, lake, since="2026-07-10").count() == 2
    assert daily.refresh_events(spark, lake).count() == 2


def test_payload_text_is_json():
    assert json.loads(message(payload())[3])["event_id"] == "e1"


def test_a_missing_raw_table_leaves_everything_as_it_was(spark, lake):
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload("a")), message(payload("b", product_id="p2"))])
    first = daily.run_daily(spark, lake, DAY, catalog=True)
    before = {n: values(m) for n, m in first.models.items()}
    raw = lake.table("events", "raw")
    os.rename(raw, raw + "_away")
    with pytest.raises(lakes.EmptySnapshotError):
        daily.refresh_events(spark, lake)
    assert {n: values(m) for n, m in first.models.items()} == before


@pytest.mark.parametrize("text,kept", [
    ("12:30:45", False), ("2026", False), ("2026-07", False), ("T12:30", False), ("soon", False),
    ("2026-07-07", True), ("2026-07-07 12:30:45", True), ("2026-07-07T12:30:45Z", True)])
def test_event_times_need_a_full_date(spark, text, kept):
    row = stg_events(spark.createDataFrame([message(payload("a", event_ts=text))], EVENT_MESSAGE)).first()
    assert (row.event_ts is not None) == kept


def test_a_run_refreshes_from_the_first_changed_day(spark, lake):
    day = 86400
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload(f"e{i}"), i * day) for i in range(4)])

    def since():
        return daily.changed_since(spark, lake, lakes.landed_files(lakes.read_events(spark, lake)))

    assert since() is None
    daily.run_daily(spark, lake, DAY, catalog=True)
    assert str(since()) == "2026-07-11"
    # files that arrive late, for a day long published
    land_events(spark, lake, [message(payload("late"), day + 7), message(payload("e3"), day + 8)])
    assert str(since()) == "2026-07-09"
    run = daily.run_daily(spark, lake, DAY)
    assert values(run.models["stg_events"]) == values(stg_events(lakes.read_events(spark, lake)))
    part = values(run.models["stg_events"])
    assert len(part) == 5
    assert str(since()) == "2026-07-11"
    assert values(daily.run_daily(spark, lake, DAY, rebuild=True).models["stg_events"]) == part


def test_an_older_day_can_use_its_own_lists(spark, lake):
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload("a")), message(payload("b", product_id="p2"))])
    daily.run_daily(spark, lake, DAY, catalog=True)
    land_day(spark, lake, NEXT, catalog=False)
    lakes.write_snapshot(lake, spark.createDataFrame([("other", "O", "EU", None)], REGULATION), "regulation", NEXT)
    daily.run_daily(spark, lake, NEXT)
    old = daily.run_daily(spark, lake, DAY, as_of=DAY)
    assert [r.product_id for r in lookup(old.models["recommendations"], "dry")] == ["p1"]
    with pytest.raises(lakes.EmptySnapshotError, match="up to 2026-01-01"):
        daily.staging_views(spark, lake, "2026-01-01")
