import datetime as dt
import json

from pyspark.sql import functions as F

from rankmill.functions.scalars import composite_key, padded_id, partition_key
from rankmill.operators.snapshot import latest_snapshot
from rankmill.plans import staging
from rankmill.sources.schemas import EVENT_MESSAGE, INGREDIENT, MANUFACTURER, PRODUCTS, REGULATION, with_partition

OLD, NEW = dt.date(2026, 7, 6), dt.date(2026, 7, 7)
T0 = dt.datetime(2026, 7, 8, 12, 0, 0)


def message(data, seconds=0, message_id="m"):
    text = data if isinstance(data, str) or data is None else json.dumps(data, ensure_ascii=False)
    return ("sub", message_id, T0 + dt.timedelta(seconds=seconds), text, "{}")


def payload(event_id="e1", **over):
    base = {
        "event_id": event_id,
        "event_type": "view",
        "event_ts": "2026-07-08T11:59:58+00:00",
        "user_id": "u1",
        "skin_type": "dry",
        "product_id": "p1",
        "session_id": "s1",
        "rating": None,
    }
    return {**base, **over}


def events(spark, rows):
    return staging.stg_events(spark.createDataFrame(rows, EVENT_MESSAGE))


def test_latest_snapshot_ignores_older_dates(spark):
    rows = [("a", "e", "s", "1", "plant", OLD), ("b", "e", "s", "2", "plant", NEW)]
    raw = spark.createDataFrame(rows, with_partition(INGREDIENT))
    assert [r.INGR_KOR_NAME for r in latest_snapshot(raw).collect()] == ["b"]
    assert [r.INGR_KOR_NAME for r in latest_snapshot(raw, as_of="2026-07-06").collect()] == ["a"]
    assert latest_snapshot(raw.limit(0)).count() == 0


def test_ingredient_name_with_english_text_wins(spark):
    rows = [
        ("물", None, "s", "1", "x", NEW),
        ("물", "Water", "s", "2", "x", NEW),
        ("물", "Zater", "s", "0", "x", NEW),
        (None, None, "s", "3", "x", NEW),
        (None, "A", "s", "4", "x", NEW),
    ]
    out = staging.stg_ingredient(spark.createDataFrame(rows, with_partition(INGREDIENT))).collect()
    assert sorted((r.ingredient_name_kr or "", r.cas_no) for r in out) == [("", "4"), ("물", "2")]


def test_regulation_keeps_rows_and_counts_empty_text_as_prohibited(spark):
    rows = [("a", "A", None, "KR", NEW), ("a", "A", "", None, NEW), ("b", "B", "EU", None, NEW)]
    out = staging.stg_regulation(spark.createDataFrame(rows, with_partition(REGULATION))).collect()
    assert [(r.ingredient_std_name, r.is_prohibited_anywhere) for r in out] == [
        ("a", False), ("a", True), ("b", True)]


def test_manufacturer_types_and_duplicates(spark):
    def row(seq, biz, permit):
        return (seq, "name", "boss", "ind", "addr", biz, permit, NEW)

    rows = [row("1", "123", "20260703")] * 3 + [
        row("2", "1234567890", "20260230"), row("3", "12345678901", None), row("4", None, "2026-07-03")]
    out = {r.company_seq: r for r in staging.stg_manufacturer(
        spark.createDataFrame(rows, with_partition(MANUFACTURER))).collect()}
    assert len(out) == 4
    assert (out["1"].business_reg_no, out["1"].permit_date) == ("0000000123", dt.date(2026, 7, 3))
    assert (out["2"].business_reg_no, out["2"].permit_date) == ("1234567890", None)
    assert (out["3"].business_reg_no, out["3"].permit_date) == ("1234567890", None)
    assert (out["4"].business_reg_no, out["4"].permit_date) == (None, None)


def test_products_pass_through(spark):
    rows = [("p1", "n", "c", "all", 1000, ["a", "b"], NEW), ("p1", "old", "c", "all", 900, [], OLD)]
    out = staging.stg_products(spark.createDataFrame(rows, with_partition(PRODUCTS))).collect()
    assert [tuple(r) for r in out] == [("p1", "n", "c", "all", 1000, ["a", "b"])]


def test_first_published_copy_survives_whatever_the_order(spark):
    rows = [message(payload(user_id=f"u{s}"), s) for s in (7, 3, 5)]
    out = events(spark, rows).collect()
    assert [(r.event_id, r.user_id) for r in out] == [("e1", "u3")]


def test_copies_published_together_resolve_the_same_way(spark):
    rows = [message(payload(user_id=u), 1) for u in ("b", "a", "c")]
    assert {events(spark, list(order)).collect()[0].user_id for order in (rows, rows[::-1])} == {"a"}


def test_unreadable_messages_are_dropped(spark):
    rows = [
        message("not json"), message(""), message(None), message('{"event_id":"x","event_type":'),
        message('[{"event_id":"x"}]'), message('"text"'), message({"event_type": "view"}),
        message({"event_id": None}), message({"event_id": {"a": 1}}), message({"event_id": [1]}),
        message("{'event_id':'x'}"), message(payload("ok")),
    ]
    assert [r.event_id for r in events(spark, rows).collect()] == ["ok"]


def test_values_that_only_look_nested_are_kept(spark):
    out = events(spark, [message(payload("[x", user_id="{y", product_id={"a": 1}))]).collect()[0]
    assert (out.event_id, out.user_id, out.product_id) == ("[x", "{y", None)


def test_numbers_as_identifiers_become_text(spark):
    assert events(spark, [message(payload(17))]).collect()[0].event_id == "17"


def test_safe_casts(spark):
    ratings = {"a": 4, "b": "4", "c": "x", "d": "4.0", "e": None, "f": "", "g": " 5 ", "h": True}
    rows = [message(payload(k, rating=v)) for k, v in ratings.items()]
    out = {r.event_id: r.rating for r in events(spark, rows).collect()}
    assert out == {"a": 4, "b": 4, "c": None, "d": None, "e": None, "f": None, "g": 5, "h": None}


def test_time_stamps_keep_micros_and_offsets(spark):
    stamps = {
        "a": "2024-01-01T00:00:07.179575+00:00", "b": "2024-01-01T09:00:07+09:00",
        "c": "2024-01-01T00:00:07Z", "d": "yesterday", "e": None}
    rows = [message(payload(k, event_ts=v)) for k, v in stamps.items()]
    out = {r.event_id: r.event_ts for r in events(spark, rows).collect()}
    second = dt.datetime(2024, 1, 1, 0, 0, 7)
    assert out == {"a": second.replace(microsecond=179575), "b": second, "c": second, "d": None, "e": None}


def test_event_and_publish_time_are_both_kept(spark):
    out = events(spark, [message(payload(), 30)]).collect()[0]
    assert out.publish_time - out.event_ts == dt.timedelta(seconds=32)


def test_scalar_helpers(spark):
    row = spark.range(1).select(
        composite_key(F.lit("a"), F.lit("b")).alias("k"),
        composite_key(F.lit(None).cast("string"), F.lit("b")).alias("n"),
        padded_id(F.lit(7), 3).alias("p"),
        partition_key(F.lit(dt.date(2026, 7, 7))).alias("d"),
    ).first()
    assert tuple(row) == ("a|b", None, "007", "20260707")
