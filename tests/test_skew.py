"""One key holding a third or more of the rows: results stay whole, work stays spread."""

import datetime as dt
import json
import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_staging import T0, payload

from rankmill.operators.delivery import delivery_reconcile
from rankmill.operators.joins import join_lookup
from rankmill.operators.profile import table_profile
from rankmill.operators.quality import quality_report
from rankmill.plans import analysis, marts
from rankmill.plans.staging import stg_events
from rankmill.session import shuffle_partitions
from rankmill.sources.schemas import EVENT_MESSAGE
from workload.adapter import Tables

N = 6000


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """Messages of which every second one is a copy of the same event."""
    rnd = random.Random(11)
    rows = []
    for i in range(N):
        key = "hot" if i % 2 else f"e{rnd.randrange(N // 4)}"
        seconds = rnd.randrange(1, 100_000)
        user = f"u{rnd.randrange(50)}"
        rows.append((key, seconds, user))
    folder = str(tmp_path_factory.mktemp("skew") / "messages")
    messages = [("s", str(i), T0 + dt.timedelta(seconds=s), json.dumps(payload(k, user_id=u)), "{}")
                for i, (k, s, u) in enumerate(rows)]
    spark.createDataFrame(messages, EVENT_MESSAGE).repartition(8).write.parquet(folder)
    return rows, spark.read.schema(EVENT_MESSAGE).parquet(folder)


def test_dedup_of_a_hot_event_id(spark, copies):
    rows, raw = copies
    best = {}
    for key, seconds, user in rows:
        best[key] = min(best.get(key, (seconds, user)), (seconds, user))
    events = stg_events(raw)
    got = {r.event_id: ((r.publish_time - T0).total_seconds(), r.user_id) for r in events.collect()}
    assert got == {k: (float(s), u) for k, (s, u) in best.items()}


def test_map_tasks_trim_copies_before_the_exchange(copies):
    plan = plan_of(stg_events(copies[1]))
    exchange = plan.index("Exchange hashpartitioning(event_id")
    assert re.search(r"WindowGroupLimit .*Partial", plan[exchange:])
    assert re.search(r"WindowGroupLimit .*Final", plan[:exchange])


def test_text_is_parsed_once_per_message(copies):
    assert plan_of(stg_events(copies[1])).count("from_json") == 1


def test_counts_over_a_hot_key(spark, copies):
    rows, raw = copies
    ids = raw.select(F.get_json_object("data", "$.event_id").alias("event_id"))
    distinct = {k for k, _, _ in rows}
    once = spark.createDataFrame([(k,) for k in distinct], "event_id string")
    out = delivery_reconcile(once, ids).first()
    assert (out.sent_events, out.landed_messages, out.lost_events) == (len(distinct), N, 0)
    profile = table_profile(ids, "t", "event_id").first()
    assert (profile.row_count, profile.distinct_keys, profile.duplicate_rows) == (N, len(distinct), N - len(distinct))
    repeated = len([k for k in distinct if sum(1 for r in rows if r[0] == k) > 1])
    report = quality_report({"stg_events": ids.withColumn("event_type", F.lit("view"))})
    assert report.where("check_name = 'unique'").first().violations == repeated


def test_hot_ingredient_with_many_rules_does_not_multiply(spark):
    """3,000 products with `water` and 2,000 rules for it would be six million pairs."""
    products = spark.range(3000).selectExpr(
        "concat('p', id) as product_id", "array('water', 'water', concat('i', id % 100)) as key_ingredients")
    regulation = spark.range(2000).selectExpr(
        "'water' as ingredient_std_name", "cast(null as string) as prohibited_in_country",
        "if(id = 1999, 'KR', null) as restricted_in_country").unionByName(
        spark.range(10).selectExpr("concat('i', id) as ingredient_std_name", "'EU' as prohibited_in_country",
                                   "cast(null as string) as restricted_in_country"))
    risk = marts.product_risk(products, regulation)
    out = risk.groupBy("has_prohibited_ingredient", "has_restricted_ingredient").count().collect()
    assert sorted(map(tuple, out)) == [(False, True, 2700), (True, True, 300)]


def test_hot_ingredient_beyond_the_broadcast_size_is_salted(spark):
    products = spark.range(0, 40_000, 1, 8).selectExpr(
        "concat('product-', id) as product_id",
        "array(if(id % 2 = 0, 'water', concat('ingredient-', id))) as key_ingredients")
    regulation = spark.range(0, 3000, 1, 4).selectExpr(
        "if(id % 3 = 0, 'water', concat('ingredient-', id)) as ingredient_std_name",
        "if(id > 0, 'EU', null) as prohibited_in_country", "cast(null as string) as restricted_in_country")
    small = marts.product_risk(products, regulation)
    large = marts.product_risk(products, regulation, broadcast_rows=10)
    assert "BroadcastHashJoin [ingredient_name" in plan_of(small)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert re.search(r"hashpartitioning\(ingredient_name#\d+, __salt", plan_of(large))
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    finally:
        spark.conf.set(threshold, before)
    contents = products.select("product_id", F.explode("key_ingredients").alias("k"))
    rules = regulation.select(F.col("ingredient_std_name").alias("k")).distinct()
    joined = join_lookup(contents, rules, "k", 3000, "product_id", broadcast_rows=10)
    # half of all rows have one key: it gets 500 parts, the other keys stay whole
    assert joined.count() == contents.join(rules, "k").count()
    assert "__parts" in plan_of(joined)


def test_pairs_of_a_hot_name_are_counted_not_built(spark):
    ingredient = spark.range(5000).selectExpr(
        "if(id % 3 = 0, 'water', concat('i', id)) as INGR_KOR_NAME", "if(id % 2 = 0, 'plant', 'mineral') as ORIGIN_MAJOR_KOR_NAME")
    regulation = spark.range(4000).selectExpr(
        "if(id % 3 = 0, 'water', concat('i', id)) as INGR_STD_NAME", "if(id % 5 = 0, 'EU', null) as PROH_NATIONAL")
    direct = ingredient.join(regulation, ingredient.INGR_KOR_NAME == regulation.INGR_STD_NAME).groupBy(
        "ORIGIN_MAJOR_KOR_NAME").agg(
        F.count_distinct("INGR_KOR_NAME"), F.round(F.avg(F.col("PROH_NATIONAL").isNotNull().cast("int")), 3))
    assert sorted(map(tuple, analysis.regulated_origin(ingredient, regulation).collect())) == sorted(
        map(tuple, direct.collect()))


def test_scores_are_combined_before_the_exchange(spark):
    events = spark.range(1000).selectExpr(
        "if(id < 900, 'dry', 'oily') as skin_type", "concat('p', id % 1) as product_id", "'view' as event_type",
        "cast(null as bigint) as rating")
    plan = plan_of(marts.skin_product_scores(events))
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(skin_type")
    assert sorted(r.views for r in marts.skin_product_scores(events).collect()) == [100, 900]


def test_shuffles_are_sized_by_the_input(spark, copies):
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(100 * 2**40) == 819_200
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(30 * 2**30)))
    try:
        assert re.search(r"Exchange hashpartitioning\(event_id#\d+, 240\)", plan_of(stg_events(copies[1])))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_file_of_one_row_group_and_many_splits_is_spread(spark, sf_dir):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        messages = Tables(spark, sf_dir).raw_events()
        rows = [r["count"] for r in messages.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert max(rows) <= sum(rows) / 3
