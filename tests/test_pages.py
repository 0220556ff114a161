import json

import pytest
from pyspark.sql import types as T

from rankmill.sources import lake as lakes
from rankmill.sources import pages

OK = {"resultCode": "00", "resultMsg": "NORMAL"}


def table(spark, *payloads, source="s"):
    rows = [(source, i, p if isinstance(p, str) or p is None else json.dumps(p, ensure_ascii=False))
            for i, p in enumerate(payloads, 1)]
    return spark.createDataFrame(rows, "source string, page_no int, payload string")


def ids(df):
    return [json.loads(r.row_text)["id"] for r in df.orderBy("page_no").collect()]


BODIES = {
    "list": ([{"id": 1}, {"id": 2}], [1, 2]),
    "item list": ({"item": [{"id": 1}, {"id": 2}]}, [1, 2]),
    "single item": ({"item": {"id": 1}}, [1]),
    "empty list": ([], []),
    "null": (None, []),
    "null item": ({"item": None}, []),
    "empty item": ({"item": []}, []),
    "no item": ({"other": 1}, []),
    "empty text": ("", []),
}


@pytest.mark.parametrize("shape", list(BODIES))
@pytest.mark.parametrize("envelope", ["legacy", "headed", "bare"])
def test_all_envelopes_and_item_shapes(spark, envelope, shape):
    items, expected = BODIES[shape]
    body = {"totalCount": 2, "items": items}
    payload = {"legacy": {"response": {"header": OK, "body": body}},
               "headed": {"header": OK, "body": body}, "bare": body}[envelope]
    df = table(spark, payload)
    assert ids(pages.unwrap_pages(df)) == expected
    assert pages.page_errors(df).count() == 0


def feed(spark, numbers, total=7):
    """Pages of three rows each in the given order of arrival; row ids tell page and place."""
    payloads = [(n, json.dumps({"header": OK, "body": {"totalCount": total, "items": [
        {"id": 10 * n + k} for k in range(3 if n < 3 else 1)]}})) for n in numbers]
    return spark.createDataFrame([("s", n, p) for n, p in payloads], "source string, page_no int, payload string")


@pytest.mark.parametrize("numbers,expected", [
    ((3, 1, 2), ("s", 3, 7, 7, True)),          # out of order
    ((1, 3, 2, 1, 3), ("s", 3, 7, 7, True)),    # copies count once
    ((1, 1, 3), ("s", 2, 4, 7, False)),         # and do not stand in for a missing page
    ((2,), ("s", 1, 3, 7, False))])
def test_completeness(spark, numbers, expected):
    df = feed(spark, numbers)
    assert tuple(pages.page_completeness(df).first()) == expected
    assert sorted(ids(pages.unwrap_pages(df))) == sorted(10 * n + k for n in set(numbers) for k in range(3 if n < 3 else 1))


def test_refused_pages_are_listed_and_incomplete(spark):
    refused = table(spark, {"header": {"resultCode": "22"}}, source="gone")
    hollow = table(spark, {"header": None, "body": {"items": [{"id": 1}]}}, {"response": None}, source="hollow")
    rows = pages.page_completeness(feed(spark, (1, 2, 3)).union(refused).union(hollow)).collect()
    assert {r.source: (r.pages, r.complete) for r in rows} == {"s": (3, True), "gone": (0, False), "hollow": (0, False)}
    assert {r.code for r in pages.page_errors(hollow).collect()} == {pages.UNREADABLE}


def test_a_missing_total_counts_as_zero(spark):
    assert pages.page_completeness(table(spark, {"items": [{"id": 1}]})).first().complete


@pytest.mark.parametrize("header,refused", [
    ({"resultCode": "30", "resultMsg": "KEY"}, ("30", "KEY")), ({"resultCode": 30}, ("30", None)),
    ({"resultCode": "00"}, None), ({"resultCode": 0}, None), ({"resultCode": "0"}, None), ({}, None)])
@pytest.mark.parametrize("legacy", [True, False])
def test_result_codes(spark, header, refused, legacy):
    page = {"header": header, "body": {"totalCount": 1, "items": [{"id": 1}]}}
    df = table(spark, {"response": page} if legacy else page)
    assert [(r.code, r.message) for r in pages.page_errors(df).collect()] == ([refused] if refused else [])
    assert pages.unwrap_pages(df).count() == (0 if refused else 1)


def test_text_that_is_no_json_is_an_error_page(spark):
    df = table(spark, "<OpenAPI_ServiceResponse/>", None, "")
    assert {r.code for r in pages.page_errors(df).collect()} == {pages.UNREADABLE}
    assert pages.page_errors(df).count() == 3


def test_landing_pages_writes_the_snapshot(spark, lake):
    row = {"INGR_KOR_NAME": "가공소금", "CAS_NO": "007", "EXTRA": 1}
    df = table(spark, {"header": OK, "body": {"totalCount": 1, "items": [row]}}, source="ingredient")
    other = table(spark, {"header": {"resultCode": "99"}}, source="regulation")
    assert pages.land_pages(lake, df.union(other), "ingredient", "2026-07-07") == 1
    assert lakes.load_snapshot(spark, lake, "ingredient", "2026-07-07") == 1
    raw = spark.read.parquet(lake.table("ingredient", "raw")).first()
    assert (raw.INGR_KOR_NAME, raw.rest) == ("가공소금", '{"EXTRA":"1"}')
    back = lakes.read_snapshot(spark, lake, "ingredient", "2026-07-07").first()
    assert (back.INGR_KOR_NAME, back.CAS_NO, back.INGR_ENG_NAME) == ("가공소금", "007", None)
    with pytest.raises(pages.PageError, match="99"):
        pages.land_pages(lake, other, "regulation", "2026-07-07")
    with pytest.raises(lakes.EmptySnapshotError):
        pages.land_pages(lake, table(spark, {"items": []}), "s", "2026-07-07")
    short = table(spark, {"header": OK, "body": {"totalCount": 3, "items": [row]}}, source="ingredient")
    with pytest.raises(pages.PageError, match="1 of 3"):
        pages.land_pages(lake, short, "ingredient", "2026-07-08")
    assert pages.land_pages(lake, short, "ingredient", "2026-07-08", partial=True) == 1


def test_a_broken_line_stops_the_load(spark, lake):
    lines = spark.createDataFrame([('{"INGR_KOR_NAME": "a"}',), ('{"INGR_KOR_NAME": ',)], "value string")
    lakes.write_snapshot_lines(lake, lines, "ingredient", "2026-07-07")
    with pytest.raises(Exception, match="(?i)malformed"):
        lakes.load_snapshot(spark, lake, "ingredient", "2026-07-07")


def test_typed_rows(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.StringType())])
    df = pages.typed_rows(pages.unwrap_pages(table(spark, {"items": [{"id": 1, "n": 5}, {"id": 2}]})), schema)
    assert [tuple(r) for r in df.collect()] == [(1, "5"), (2, None)]
