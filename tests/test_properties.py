"""Random inputs against plain Python, for the operators whose order or ties matter."""

import datetime as dt
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_staging import T0, payload

from rankmill.operators.ranking import rank_within
from rankmill.plans.staging import stg_events
from rankmill.sources.schemas import EVENT_MESSAGE

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.sampled_from(["a", "b", "c", "가", ""])


@few
@given(rows=st.lists(st.tuples(keys, st.integers(0, 3), st.sampled_from(["u1", "u2", None])), max_size=25))
def test_dedup_picks_the_smallest_row_per_id(spark, rows):
    messages = [("s", str(i), T0 + dt.timedelta(seconds=s), json.dumps(payload(k, user_id=u), ensure_ascii=False), None)
                for i, (k, s, u) in enumerate(rows)]
    expected = {}
    for key, seconds, user in rows:
        order = (seconds, user is None, user or "")
        if key not in expected or order < expected[key][0]:
            expected[key] = (order, user)
    got = stg_events(spark.createDataFrame(messages, EVENT_MESSAGE)).collect()
    assert {r.event_id: ((r.publish_time - T0).seconds, r.user_id) for r in got} == {
        k: (order[0], user) for k, (order, user) in expected.items()}
    assert len(got) == len(expected)


@few
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2)), max_size=30))
def test_both_rank_paths_number_rows_alike(spark, rows):
    df = spark.createDataFrame([(g, float(v), i) for i, (g, v) in enumerate(rows)], "g string, v double, id bigint")
    order = [F.desc("v"), F.asc("id")]
    window = rank_within(df, ["g"], order, "rank", group_rows_bound=len(rows)).collect()
    ranges = rank_within(df.repartition(3), ["g"], order, "rank").collect()
    assert sorted(map(str, window)) == sorted(map(str, ranges))
    expected = {}
    for i, (g, v) in sorted(enumerate(rows), key=lambda r: (-r[1][1], r[0])):
        expected[i] = 1 + sum(1 for j in expected if rows[j][0] == g)
    assert {r.id: r["rank"] for r in window} == expected
