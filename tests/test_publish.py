"""Dates and marts that readers never see half done, and runs that go on where they stopped."""

import json
import os

import pytest
from conftest import plan_of
from test_daily import DAY, land_day, land_events, values
from test_lake import A, B, ingredients, names
from test_staging import message, payload

from rankmill.operators.quality import DataQualityError
from rankmill.plans import daily, marts
from rankmill.plans.serving import recommend
from rankmill.sources import lake as lakes
from rankmill.sources import notes
from rankmill.sources.pages import missing_pages
from rankmill.sources.schemas import SOURCES


# -- notes --------------------------------------------------------------------------------


def test_the_newest_note_counts_and_few_are_kept(spark, tmp_path):
    folder = str(tmp_path / "notes")
    assert notes.read_note(spark, folder) is None and notes.note_number(spark, folder) == 0
    for n in range(1, 6):
        assert notes.write_note(spark, folder, {"n": n, "text": "é식"}) == n
    assert notes.read_note(spark, folder) == {"n": 5, "text": "é식"}
    assert len([f for f in os.listdir(folder) if f.endswith(".json") and not f.startswith(".")]) == notes.KEPT


def test_a_note_of_another_writer_is_not_overwritten(spark, tmp_path):
    folder = str(tmp_path / "notes")
    notes.write_note(spark, folder, {"by": "one"})
    with pytest.raises(notes.NoteConflict):
        notes.write_note(spark, folder, {"by": "two"}, after=0)
    assert notes.read_note(spark, folder) == {"by": "one"}


# -- one date -----------------------------------------------------------------------------


def loaded(spark, lake):
    return names(lakes.read_raw(spark, lake, "ingredient"))


def test_a_load_that_fails_its_audit_leaves_the_date(spark, lake):
    lakes.write_snapshot(lake, ingredients(spark, "a"), "ingredient", A)
    lakes.load_snapshot(spark, lake, "ingredient", A)
    lakes.write_snapshot(lake, ingredients(spark, "b", "c"), "ingredient", A)
    seen = []

    def refuse(rows):
        seen.extend(sorted(r.INGR_KOR_NAME for r in rows.collect()))
        raise DataQualityError("no")

    with pytest.raises(DataQualityError):
        lakes.load_snapshot(spark, lake, "ingredient", A, refuse)
    assert seen == ["b", "c"] and loaded(spark, lake) == [(A, "a")]
    assert os.listdir(os.path.join(lake.table("ingredient", "raw"), lakes.STAGED)) == []
    assert lakes.load_snapshot(spark, lake, "ingredient", A, lambda rows: None) == 2
    assert loaded(spark, lake) == [(A, "b"), (A, "c")]


def test_a_move_that_fails_brings_the_old_date_back(spark, lake, monkeypatch):
    for day, name in ((A, "a"), (B, "b")):
        lakes.write_snapshot(lake, ingredients(spark, name), "ingredient", day)
        lakes.load_snapshot(spark, lake, "ingredient", day)
    move = lakes._move

    def fails(spark, source, target):
        if lakes.STAGED in source:
            raise OSError("store gone")
        move(spark, source, target)

    monkeypatch.setattr(lakes, "_move", fails)
    with pytest.raises(OSError):
        lakes.load_snapshot(spark, lake, "ingredient", A)
    assert loaded(spark, lake) == [(A, "a"), (B, "b")]


def test_a_run_that_died_between_two_moves_is_restored(spark, lake):
    path = lake.table("ingredient", "raw")
    lakes.write_snapshot(lake, ingredients(spark, "a"), "ingredient", A)
    lakes.load_snapshot(spark, lake, "ingredient", A)
    lakes._move(spark, f"{path}/dt={A}", f"{path}/{lakes.REPLACED}/dt={A}")
    assert lakes.restore_partitions(spark, path) == [f"dt={A}"]
    assert loaded(spark, lake) == [(A, "a")] and lakes.restore_partitions(spark, path) == []


# -- marts --------------------------------------------------------------------------------


def test_both_tables_switch_together_and_a_failure_changes_nothing(spark, lake):
    def tables(n):
        return {"x": spark.range(n), "y": spark.range(10 * n)}

    def read():
        return [lakes.read_published(spark, lake, name, "marts").count() for name in ("x", "y")]

    with pytest.raises(lakes.EmptySnapshotError):
        read()
    lakes.publish_tables(spark, lake, "marts", tables(1))
    held = lakes.read_published(spark, lake, "x", "marts")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|by zero"):
        lakes.publish_tables(spark, lake, "marts", {"x": spark.range(2), "y": spark.range(9).selectExpr("1 div (id - id) as id")})
    with pytest.raises(DataQualityError):
        lakes.publish_tables(spark, lake, "marts", tables(3), audit=lambda t: (_ for _ in ()).throw(DataQualityError("no")))
    assert read() == [1, 10]
    for n in (4, 5, 6):
        lakes.publish_tables(spark, lake, "marts", tables(n))
        assert read() == [n, 10 * n]
    versions = os.listdir(os.path.join(lake.root, "warehouse", "marts", "versions"))
    assert len(versions) == lakes.KEPT_VERSIONS
    with pytest.raises(Exception, match="NOT_EXIST|not exist"):  # the oldest version is gone by now
        held.count()


def test_a_run_whose_checks_fail_keeps_the_old_marts(spark, lake):
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload("a"))])
    daily.run_daily(spark, lake, DAY, catalog=True)
    before = values(daily.read_mart(spark, lake, "recommendations"))
    land_events(spark, lake, [message(payload("b", event_type="share")), message(payload("c", product_id="p1"))])
    with pytest.raises(DataQualityError, match="event_type"):
        daily.run_daily(spark, lake, DAY)
    assert values(daily.read_mart(spark, lake, "recommendations")) == before
    run = daily.run_daily(spark, lake, DAY, check=False)
    assert values(daily.read_mart(spark, lake, "recommendations")) == values(run.models["recommendations"]) != before


def test_a_lookup_opens_one_segment_and_skips_row_groups_by_rank(spark, lake):
    rows = spark.range(20_000).selectExpr(
        "case id % 4 when 0 then 'dry' when 1 then 'oily' when 2 then 'robot' end as skin_type", "id div 4 + 1 as rank", "cast(id as string) as product_id",
        "repeat('n', 20) as product_name", "'c' as category", "id as price_krw", "cast(1.0 as double) as score", "false as has_restricted_ingredient")
    lakes.publish_tables(spark, lake, "marts", {"recommendations": rows}, layouts=daily.LAYOUTS)
    mart = daily.read_mart(spark, lake, "recommendations")
    assert mart.columns == rows.columns and values(mart) == values(rows)
    top = recommend(mart, "oily", 3)
    assert [r.product_id for r in top.collect()] == ["1", "5", "9"]
    plan = plan_of(top)
    assert "skin_type#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "LessThanOrEqual(rank,3)" in plan
    folder = os.path.join(lake.root, "warehouse", "marts", "versions")
    (version,) = os.listdir(folder)
    parts = os.listdir(os.path.join(folder, version, "recommendations"))
    assert {p for p in parts if "=" in p} == {f"skin_type={v}" for v in ("dry", "oily", "robot", "__HIVE_DEFAULT_PARTITION__")}


def test_known_row_counts_are_taken_instead_of_counting(spark, lake, monkeypatch):
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload("a"))])
    run = daily.run_daily(spark, lake, DAY, catalog=True)
    assert daily.loaded_rows(spark, lake) == {"ingredient": 1, "regulation": 1, "manufacturer": 2, "products": 2}
    scores = marts.skin_product_scores(run.models["stg_events"])

    def refuse(self):
        raise AssertionError("counted while the plan was made")

    monkeypatch.setattr(type(scores), "count", refuse)
    known = {"products": 2, "regulation": 1}
    assert values(marts.rank_products(scores, run.models["stg_products"], run.models["stg_regulation"], loaded=known)) == values(run.models["recommendations"])


# -- stages -------------------------------------------------------------------------------


def feeds(spark, refused=(), short=()):
    """Pages of two rows each for every master list."""
    rows = []
    for name, source in SOURCES.items():
        columns = source.schema.fieldNames()
        total = 9 if name in short else 3
        for page, n in ((1, 2), (2, 1)):
            items = [{c: f"{name} {page} {i}" for c in columns} for i in range(n)]
            body = {"header": {"resultCode": "00"}, "body": {"totalCount": total, "items": items}}
            if name in refused and page == 2:
                body = {"header": {"resultCode": "30", "resultMsg": "key not registered"}}
            rows.append((name, page, json.dumps(body)))
    return spark.createDataFrame(rows, "source string, page_no int, payload string")


def test_failed_sources_are_named_and_done_ones_are_not_landed_again(spark, lake, monkeypatch):
    landed = []
    whole = daily.land_pages
    monkeypatch.setattr(daily, "land_pages", lambda lake, pages, name, *a: landed.append(name) or whole(lake, pages, name, *a))
    with pytest.raises(daily.StageError, match="land failed for") as failure:
        daily.land_day(spark, lake, feeds(spark, refused=["regulation"], short=["manufacturer"]), DAY)
    assert "regulation: [regulation] page 2: code 30" in str(failure.value) and "3 of 9" in str(failure.value)
    assert sorted(landed) == sorted(SOURCES) and os.path.isdir(lake.snapshot("ingredient", DAY))
    landed.clear()
    assert daily.land_day(spark, lake, feeds(spark), DAY) == dict.fromkeys(SOURCES, 3)
    assert sorted(landed) == ["manufacturer", "regulation"]
    landed.clear()
    assert daily.land_day(spark, lake, feeds(spark), DAY) == dict.fromkeys(SOURCES, 3) and landed == []


def test_a_source_without_pages_is_named(spark, lake):
    with pytest.raises(daily.StageError, match="manufacturer"):
        daily.land_day(spark, lake, feeds(spark).where("source <> 'manufacturer'"), DAY)


def test_a_run_skips_what_is_done_with_the_same_input(spark, lake):
    land_day(spark, lake, DAY)
    land_events(spark, lake, [message(payload("a"))])
    first = daily.run_daily(spark, lake, DAY, catalog=True)
    assert first.skipped == ()
    again = daily.run_daily(spark, lake, DAY, catalog=True)
    assert again.skipped == tuple(f"load {n}" for n in [*SOURCES, "products"]) and again.loaded == first.loaded
    land_day(spark, lake, DAY, catalog=False)
    assert daily.run_daily(spark, lake, DAY, catalog=True).skipped == ("load products",)


# -- missing pages ------------------------------------------------------------------------


def page(source, number, rows=2, total=20, code="00"):
    items = [{"x": i} for i in range(rows)]
    return source, number, json.dumps({"header": {"resultCode": code}, "body": {"totalCount": total, "items": items}})


def test_runs_of_missing_pages(spark):
    rows = [page("a", n) for n in (2, 3, 6)] + [page("a", n, 0, 0, "30") for n in (4, 5, 8)]
    rows += [page("b", n, total=6) for n in (1, 2, 3)] + [page("b", 2, total=6), ("b", None, "x")]
    rows += [page("c", 1, 0, 0, "30"), page("d", 1, 0, 0)]
    pages = spark.createDataFrame(rows, "source string, page_no int, payload string").repartition(3)
    got = sorted((r.source, r.kind, r.first_page, r.last_page, r.pages) for r in missing_pages(pages).collect())
    # ten pages of two rows from page 2 on; 7 lies between, 9 to 11 come after what is there
    assert got == [("a", "absent", 7, 7, 1), ("a", "absent", 9, 11, 3), ("a", "refused", 4, 5, 2), ("a", "refused", 8, 8, 1),
                   ("c", "refused", 1, 1, 1)]
    from_one = missing_pages(pages, first_page=1)
    assert ("a", "absent", 1, 1) in {(r.source, r.kind, r.first_page, r.last_page) for r in from_one.collect()}
    assert missing_pages(pages.where("false")).collect() == []
