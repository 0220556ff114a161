"""Sketches of days, merged, against exact figures of the range."""

import datetime as dt

import numpy as np

from rankmill.plans import sketches

EVENTS = "event_type string, event_ts timestamp, publish_time timestamp, user_id string, product_id string"


def test_merged_days_are_within_the_stated_error(spark):
    draw = np.random.default_rng(3)
    start, rows = dt.datetime(2026, 7, 1, 12), []
    for k in range(60_000):
        at = start + dt.timedelta(days=int(draw.integers(0, 20)))
        lag = dt.timedelta(microseconds=int(draw.gamma(2, 1e6)))
        rows.append(("view", at, at + lag, f"u{draw.integers(0, 40_000)}", f"p{k % 50}"))
    table = spark.createDataFrame(rows, EVENTS).repartition(4)
    days = sketches.day_sketches(table).cache()
    assert days.count() == 20
    (got,) = sketches.range_activity(days, "2026-07-05", dt.date(2026, 7, 16)).collect()
    inside = [r for r in rows if dt.date(2026, 7, 5) <= r[1].date() <= dt.date(2026, 7, 16)]
    lags = np.sort([(r[2] - r[1]) // dt.timedelta(microseconds=1) for r in inside])
    assert got.events == len(inside) and got.touched_products == 50
    users = len({r[3] for r in inside})
    assert abs(got.active_users - users) <= 0.024 * users
    for name, q in sketches.QUANTILES.items():
        assert abs(np.searchsorted(lags, got[name]) / len(lags) - q) <= 0.012
    days.unpersist()


def test_days_without_lags_and_empty_ranges(spark):
    noon = dt.datetime(2026, 7, 1, 12)
    table = spark.createDataFrame([("view", noon, None, "u", None), ("view", None, noon, "v", "p"), (None, noon, noon, None, "p")], EVENTS)
    days = sketches.day_sketches(table)
    got = {r.event_type: r for r in sketches.range_activity(days, "2026-07-01", "2026-07-01").collect()}
    assert (got["view"].events, got["view"].active_users, got["view"].p50_lag_us) == (1, 1, None)
    assert (got[None].events, got[None].active_users, got[None].p95_lag_us) == (1, 0, 0)
    assert sketches.range_activity(days, "2025-01-01", "2025-12-31").collect() == []
