import pytest

from rankmill.operators import quality
from rankmill.operators.delivery import arrival_lag, delivery_reconcile, delivery_status, lost_keys
from rankmill.operators.profile import table_profile
from rankmill.operators.quality import CHECKS, Check, DataQualityError, quality_report


def counts(report):
    return {(r.column_name, r.check_name): r.violations for r in report.collect()}


def test_seventeen_checks_are_declared():
    assert len(CHECKS) == 17 and len(set(CHECKS)) == 17


def test_report_on_one_model(spark):
    rows = [("a", "view"), ("a", "view"), ("a", "share"), ("b", None), (None, "view"), (None, "x")]
    df = spark.createDataFrame(rows, "event_id string, event_type string")
    report = quality_report({"stg_events": df})
    assert counts(report) == {("event_id", "not_null"): 2, ("event_id", "unique"): 1,
                              ("event_type", "accepted_values"): 2}
    with pytest.raises(DataQualityError, match="stg_events.event_id unique: 1"):
        quality.enforce(report)


def test_empty_and_clean_models_pass(spark):
    df = spark.createDataFrame([], "event_id string, event_type string")
    report = quality_report({"stg_events": df})
    assert set(counts(report).values()) == {0}
    quality.enforce(report)


def test_missing_key_shows_in_the_key_check_only(spark):
    mart = spark.createDataFrame([(None, None, 1.0, 1), ("dry|p", "dry", None, None)],
                                 "rec_key string, skin_type string, score double, rank bigint")
    assert counts(quality_report({"recommendations": mart})) == {
        ("rec_key", "not_null"): 1, ("rec_key", "unique"): 0, ("skin_type", "accepted_values"): 0,
        ("score", "not_null"): 1, ("rank", "not_null"): 1}


def test_violating_rows_can_be_listed(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert [tuple(r) for r in quality.violating(df, Check("m", "k", quality.UNIQUE)).collect()] == [("a", 2)]
    assert quality.violating(df, Check("m", "k", quality.NOT_NULL)).count() == 1
    assert quality.violating(df, Check("m", "k", quality.ACCEPTED, ("b",))).count() == 2


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, v int")
    assert tuple(table_profile(df, "t", "k").first()) == ("t", 6, 2, 2, 2)
    assert tuple(table_profile(df.limit(0), "t", "k").first()) == ("t", 0, 0, 0, 0)


def test_reconcile(spark):
    sent = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "event_id string")
    landed = spark.createDataFrame([("a",), ("a",), ("b",), ("z",)], "event_id string")
    assert tuple(delivery_reconcile(sent, landed).first()) == (3, 4, 2, 1, 1, 1)
    assert [r.event_id for r in lost_keys(delivery_status(sent, landed)).collect()] == ["c"]


def test_lag(spark):
    df = spark.sql("""select 'view' as event_type, timestamp'2026-01-01 00:00:00' as event_ts,
                      timestamp'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as publish_time
                      from range(1, 101) union all select 'view', null, current_timestamp()""")
    row = arrival_lag(df).first()
    assert (row.events, row.min_lag_us, row.max_lag_us, row.p50_lag_us, row.p95_lag_us) == (
        100, 1_000_000, 100_000_000, 50_000_000, 95_000_000)
