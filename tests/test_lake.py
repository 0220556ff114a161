import datetime as dt
import os

import pytest
from conftest import plan_of

from rankmill.plans.staging import stg_ingredient
from rankmill.sources import lake as lakes
from rankmill.sources.lake import EmptySnapshotError, Lake
from rankmill.sources.schemas import INGREDIENT, MANUFACTURER, pick

A, B = "2026-07-06", "2026-07-07"


def ingredients(spark, *names):
    return spark.createDataFrame([(n, None, None, None, "식물") for n in names], INGREDIENT)


def names(df):
    return sorted((str(r.dt), r.INGR_KOR_NAME) for r in df.select("dt", "INGR_KOR_NAME").collect())


def text_of(folder):
    lines = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            with open(os.path.join(folder, name), encoding="utf-8") as file:
                lines += file.read().splitlines()
    return lines


def test_layout():
    lake = Lake("store://bucket")
    assert lake.snapshot("ingredient", A) == "store://bucket/raw/ingredient/dt=2026-07-06"
    assert lake.snapshot("ingredient", A).startswith(lake.landing("ingredient") + "/")
    assert lakes.partition_address("regulation", B) == "regulation$20260707"
    assert lake.table("m") == "store://bucket/warehouse/staging/m"
    assert lake.table("m", " marts ") == "store://bucket/warehouse/marts/m"


def test_registry():
    assert [s.name for s in pick("all")] == ["ingredient", "regulation", "manufacturer"]
    assert [s.name for s in pick("products")] == ["products"]
    with pytest.raises(ValueError):
        pick("nowhere")


def test_json_lines_keep_text_and_nulls(spark, lake):
    assert lakes.write_snapshot(lake, ingredients(spark, "가공소금"), "ingredient", A) == 1
    lines = text_of(lake.snapshot("ingredient", A))
    assert len(lines) == 1
    assert '"INGR_KOR_NAME":"가공소금"' in lines[0] and '"CAS_NO":null' in lines[0]


def test_writing_a_date_again_replaces_it(spark, lake):
    lakes.write_snapshot(lake, ingredients(spark, "a"), "ingredient", A)
    lakes.write_snapshot(lake, ingredients(spark, "b", "c"), "ingredient", B)
    lakes.write_snapshot(lake, ingredients(spark, "d"), "ingredient", B)
    assert names(lakes.read_snapshot(spark, lake, "ingredient")) == [(A, "a"), (B, "d")]
    assert names(lakes.read_snapshot(spark, lake, "ingredient", A)) == [(A, "a")]


def test_loading_is_idempotent_and_leaves_other_dates(spark, lake):
    for day, rows in ((A, ["a"]), (B, ["b", "c"])):
        lakes.write_snapshot(lake, ingredients(spark, *rows), "ingredient", day)
        assert lakes.load_snapshot(spark, lake, "ingredient", day) == len(rows)
    assert lakes.load_snapshot(spark, lake, "ingredient", A) == 1
    assert names(lakes.read_raw(spark, lake, "ingredient")) == [(A, "a"), (B, "b"), (B, "c")]
    assert names(lakes.read_raw_date(spark, lake, "ingredient")) == [(B, "b"), (B, "c")]
    assert names(lakes.read_raw_date(spark, lake, "ingredient", A)) == [(A, "a")]


def test_empty_snapshots_are_refused_and_change_nothing(spark, lake):
    lakes.write_snapshot(lake, ingredients(spark, "a"), "ingredient", A)
    with pytest.raises(EmptySnapshotError):
        lakes.write_snapshot(lake, ingredients(spark), "ingredient", A)
    assert names(lakes.read_snapshot(spark, lake, "ingredient")) == [(A, "a")]
    with pytest.raises(EmptySnapshotError):
        lakes.read_raw_date(spark, lake, "ingredient")


def test_fixed_schema_keeps_leading_zeros_and_inference_is_optional(spark, lake):
    rows = spark.createDataFrame([("007", "n", "b", "i", "f", "0123", "20260703")], MANUFACTURER)
    lakes.write_snapshot(lake, rows, "manufacturer", A)
    assert lakes.read_snapshot(spark, lake, "manufacturer", A).first().ENTP_SEQ == "007"
    inferred = lakes.read_snapshot(spark, lake, "manufacturer", A, infer=True)
    assert inferred.first().BIZRNO == "0123"


def test_load_sources_reports_rows_per_source(spark, lake):
    from rankmill.sources.schemas import SOURCES

    for name, source in SOURCES.items():
        row = tuple("x" for _ in source.schema)
        lakes.write_snapshot(lake, spark.createDataFrame([row, row], source.schema), name, A)
    assert lakes.load_sources(spark, lake, A) == {"ingredient": 2, "regulation": 2, "manufacturer": 2}
    assert lakes.load_sources(spark, lake, A, "regulation") == {"regulation": 2}


def test_a_pinned_date_reads_one_partition_and_few_columns(spark, lake):
    for day in (A, B):
        lakes.write_snapshot(lake, ingredients(spark, "a"), "ingredient", day)
        lakes.load_snapshot(spark, lake, "ingredient", day)
    model = stg_ingredient(lakes.read_raw(spark, lake, "ingredient"), as_of=B)
    plan = plan_of(model.select("origin_major_kr"))
    assert "PartitionFilters: [isnotnull(dt" in plan and "2026-07-07" in plan
    model = stg_ingredient(lakes.read_raw(spark, lake, "ingredient"))
    assert "PartitionFilters: [isnotnull(dt" in plan_of(model) and "Subquery" in plan_of(model)
    plan = plan_of(lakes.read_raw(spark, lake, "ingredient").select("CAS_NO"))
    assert "ReadSchema: struct<CAS_NO:string>" in plan


def test_reports_are_overwritten_per_date(spark, lake, capsys):
    df = spark.range(30)
    out = lakes.write_report(df, lake, "r", A, single_file=True, preview=20)
    assert "only showing top 20 rows" in capsys.readouterr().out
    assert len([f for f in os.listdir(lake.report("r", A)) if f.startswith("part-")]) == 1
    assert out.count() == 30
    assert lakes.write_report(spark.range(3), lake, "r", A).count() == 3


def test_retention_marks_old_partitions_but_never_the_newest(spark):
    rows = [("daily", dt.date(2026, 1, 1)), ("daily", dt.date(2026, 4, 8)), ("daily", dt.date(2026, 4, 9)),
            ("daily", dt.date(2026, 7, 8)), ("rare", dt.date(2025, 1, 1)), ("rare", dt.date(2025, 2, 1))]
    table = spark.createDataFrame(rows, "table_name string, dt date")
    out = lakes.retention(table, "2026-07-08").where("expired").collect()
    assert sorted((r.table_name, str(r.dt)) for r in out) == [
        ("daily", "2026-01-01"), ("daily", "2026-04-08"), ("rare", "2025-01-01")]


def test_expired_folders_are_listed_and_dropped_on_request(spark, lake):
    for day in ("2026-01-01", "2026-02-01", B):
        lakes.write_snapshot(lake, ingredients(spark, day), "ingredient", day)
    path = lake.landing("ingredient")
    expired = lakes.expired_dates(spark, lake, path, B)
    assert expired == [dt.date(2026, 1, 1), dt.date(2026, 2, 1)]
    assert len(lake.dates(spark, path)) == 3
    lakes.drop_partitions(spark, path, expired)
    assert lake.dates(spark, path) == [dt.date(2026, 7, 7)]
    assert lakes.expired_dates(spark, lake, path, "2030-01-01") == []
