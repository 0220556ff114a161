import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rankmill.operators.ranking import rank_within, top_n_per_group
from rankmill.plans import analysis, marts

EVENTS = ("event_id string, event_type string, event_ts timestamp, user_id string, skin_type string, "
          "product_id string, session_id string, rating bigint, publish_time timestamp")
PRODUCTS = ("product_id string, product_name string, category string, target_skin_type string, "
            "price_krw bigint, key_ingredients array<string>")
REGULATION = ("ingredient_std_name string, ingredient_name_en string, prohibited_in_country string, "
              "restricted_in_country string, is_prohibited_anywhere boolean")
T0 = dt.datetime(2026, 7, 8, 12)


def make_events(spark, rows):
    """rows of (segment, product, type[, rating[, user[, time]]])"""
    full = []
    for i, row in enumerate(rows):
        segment, product, kind, rating, user, ts = (*row, *[None, "u1", T0][len(row) - 3:])
        full.append((f"e{i}", kind, ts, user, segment, product, "s", rating, ts))
    return spark.createDataFrame(full, EVENTS)


def make_products(spark, contents):
    rows = [(p, f"name {p}", "cat", "all", 1000, list_) for p, list_ in contents.items()]
    return spark.createDataFrame(rows, PRODUCTS)


@pytest.fixture(scope="module")
def rules(spark):
    rows = [
        ("banned", "B", "EU", None, True), ("limited", "L", None, "KR", False),
        ("both", "X", "EU", "KR", True), ("many", "M", None, None, False),
        ("many", "M", None, "KR", False), ("many", "M", None, "JP", False), ("listed", "N", None, None, False),
    ]
    return spark.createDataFrame(rows, REGULATION)


CONTENTS = {
    "p_ban": ["water", "banned"], "p_lim": ["limited"], "p_both": ["both"], "p_many": ["many", "many"],
    "p_clean": ["water"], "p_listed": ["listed"], "p_empty": [], "p_null": None,
}


def test_product_risk(spark, rules):
    out = {r.product_id: (r.has_prohibited_ingredient, r.has_restricted_ingredient)
           for r in marts.product_risk(make_products(spark, CONTENTS), rules).collect()}
    assert out == {
        "p_ban": (True, False), "p_lim": (False, True), "p_both": (True, True),
        "p_many": (False, True), "p_listed": (False, False)}


def test_regulation_filter_per_segment(spark, rules):
    products = make_products(spark, CONTENTS)
    events = make_events(spark, [(s, p, "view") for s in ("dry", "sensitive", None) for p in CONTENTS])
    out = marts.recommendations(events, products, rules).collect()
    got = {s: {r.product_id for r in out if r.skin_type == s} for s in ("dry", "sensitive", None)}
    free = {"p_clean", "p_listed", "p_empty", "p_null"}
    assert got["dry"] == free | {"p_lim", "p_many"}
    assert got["sensitive"] == free
    # an unknown segment is kept while nothing is restricted, and dropped otherwise
    assert got[None] == free
    assert {r.product_id for r in out if r.has_restricted_ingredient} == {"p_lim", "p_many"}
    assert {r.rec_key for r in out if r.skin_type is None} == {None}
    assert {r.rec_key for r in out if r.product_id == "p_lim"} == {"dry|p_lim"}


def test_scores_counts_and_ratings(spark):
    events = make_events(spark, [
        ("dry", "a", "view"), ("dry", "a", "view"), ("dry", "a", "like"), ("dry", "a", "purchase"),
        ("dry", "a", "rating", 4), ("dry", "a", "rating", 5), ("dry", "a", "rating", None),
        ("dry", "b", "like"), ("oily", "a", "share")])
    out = {(r.skin_type, r.product_id): tuple(r)[2:] for r in marts.skin_product_scores(events).collect()}
    assert out[("dry", "a")] == (2, 1, 1, 4.5, 2 + 3 + 5 + 9.0)
    assert out[("dry", "b")] == (0, 1, 0, None, 3.0)
    assert out[("oily", "a")] == (0, 0, 0, None, 0.0)
    heavier = marts.skin_product_scores(events, marts.Weights(view=10, rating=0))
    assert {r.product_id: r.score for r in heavier.collect() if r.skin_type == "dry"} == {"a": 28.0, "b": 3.0}


def test_ranks_are_gap_free_and_ties_follow_the_product_id(spark, rules):
    products = make_products(spark, {"c": [], "a": [], "b": [], "x": ["banned"]})
    events = make_events(spark, [("dry", p, "view") for p in ("c", "a", "b", "x", "unknown")]
                         + [("dry", "b", "purchase"), ("dry", "x", "purchase"), ("dry", "unknown", "purchase")])
    out = marts.recommendations(events, products, rules).orderBy("rank").collect()
    assert [(r.rank, r.product_id) for r in out] == [(1, "b"), (2, "a"), (3, "c")]


def test_rank_uses_the_unrounded_score(spark, rules):
    events = make_events(spark, [("dry", "b", "rating", r) for r in [5] * 667 + [4] * 333]
                         + [("dry", "a", "rating", r) for r in [5] * 6665 + [4] * 3335])
    out = marts.recommendations(events, make_products(spark, {"a": [], "b": []}), rules).orderBy("rank").collect()
    assert [r.product_id for r in out] == ["b", "a"]
    assert out[0].avg_rating == out[1].avg_rating == 4.67


def test_both_rank_paths_agree(spark, rules):
    rnd = random.Random(5)
    products = make_products(spark, {f"p{i:03d}": [] for i in range(300)})
    segments = ["dry"] * 4 + ["oily", "normal", None]
    events = make_events(spark, [(rnd.choice(segments), f"p{rnd.randrange(300):03d}", rnd.choice(["view", "like"]))
                                 for _ in range(1500)])
    small = marts.recommendations(events, products, rules)
    large = marts.recommendations(events, products, rules, rows_per_task=10)
    assert "Scan ExistingRDD" in large._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_range_rank_with_one_hot_group_and_hot_ties(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot", "hot", "b", None]), rnd.choice([1.0, 1.0, 1.0, 2.5, rnd.random()]), i)
            for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, score double, id bigint").repartition(8)
    out = rank_within(df, ["g"], [F.desc("score"), F.asc("id")], "rank").collect()
    assert len(out) == len(rows)
    for group in ("hot", "b", None):
        expected = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2]))
        got = sorted((r for r in out if r.g == group), key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, len(expected) + 1))
        assert [r.id for r in got] == [r[2] for r in expected]


def test_range_rank_of_nothing(spark):
    df = spark.createDataFrame([], "g string, score double")
    assert rank_within(df, ["g"], [F.desc("score")], "rank").collect() == []


def test_top_n_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9)], "g string, v int")
    out = top_n_per_group(df, ["g"], [F.desc("v")], 2).collect()
    assert sorted((r.g, r.v, r["rank"]) for r in out) == [("a", 2, 2), ("a", 3, 1), ("b", 9, 1)]


def test_top_n_beyond_the_group_limit(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'a', 'b') as g", "id as v")
    out = top_n_per_group(df, ["g"], [F.desc("v")], 1500)
    assert [r["count"] for r in out.groupBy("g").count().orderBy("g").collect()] == [1000, 1500]
    assert out.agg(F.max("rank")).first()[0] == 1500


def test_daily_activity_splits_at_utc_midnight(spark):
    late, early = dt.datetime(2026, 7, 8, 23, 59, 59), dt.datetime(2026, 7, 9)
    events = make_events(spark, [
        ("dry", "a", "view", None, "u1", late), ("dry", "b", "view", None, "u1", late),
        ("dry", "a", "view", None, "u1", early), ("dry", "a", "rating", 4, "u2", early),
        ("dry", "a", "rating", 5, "u3", early), ("dry", "a", "rating", None, "u3", early)])
    daily = marts.events_daily(events)
    out = {(str(r.event_date), r.event_type): tuple(r)[2:] for r in daily.collect()}
    assert out == {("2026-07-08", "view"): (2, 1, 2, None), ("2026-07-09", "view"): (1, 1, 1, None),
                   ("2026-07-09", "rating"): (3, 2, 1, 4.5)}
    # one user on two days counts twice on the scorecard
    assert tuple(analysis.kpi_scorecard(daily.where("event_type = 'view'")).first()) == (3, 2)
    assert {r.events for r in marts.events_daily(events, approximate=True).collect()} == {2, 1, 3}


def test_regulated_origin_weights_by_pairs(spark):
    ingredient = spark.createDataFrame(
        [("a", "plant"), ("a", "plant"), ("b", "plant"), ("c", "mineral"), ("z", "mineral"), (None, "plant")],
        "INGR_KOR_NAME string, ORIGIN_MAJOR_KOR_NAME string")
    regulation = spark.createDataFrame(
        [("a", "EU"), ("a", None), ("b", None), ("c", "EU"), ("q", "EU"), (None, "EU")],
        "INGR_STD_NAME string, PROH_NATIONAL string")
    joined = ingredient.join(regulation, ingredient.INGR_KOR_NAME == regulation.INGR_STD_NAME)
    direct = {r.o: (r.n, r.q) for r in joined.groupBy(F.col("ORIGIN_MAJOR_KOR_NAME").alias("o")).agg(
        F.count_distinct("INGR_KOR_NAME").alias("n"),
        F.round(F.avg(F.when(F.col("PROH_NATIONAL").isNotNull(), 1).otherwise(0)), 3).alias("q")).collect()}
    out = analysis.regulated_origin(ingredient, regulation).collect()
    assert [tuple(r) for r in out] == [("plant", 2, 0.4), ("mineral", 1, 1.0)]
    assert {r[0]: (r[1], r[2]) for r in out} == direct


def test_match_rate(spark):
    mart = spark.createDataFrame(
        [("dry", "dry", 1), ("dry", "oily", 2), ("oily", "all", 1), ("oily", "dry", 9)],
        "skin_type string, target_skin_type string, rank bigint")
    products = spark.createDataFrame([("dry",), ("all",), ("other",), (None,)], "target_skin_type string")
    out = analysis.topk_match_rate(mart, products).first()
    assert tuple(out) == (3, 0.6667, 20, 0.3)


def test_catalog_names_limit(spark):
    names = spark.createDataFrame([("b",), (None,), ("a",), ("c",)], "ingredient_name_kr string")
    assert [r[0] for r in analysis.catalog_names(names, 2).collect()] == ["a", "b"]


def test_dashboard_top(spark):
    mart = spark.createDataFrame([("dry", 5, "n", 1.0), ("dry", 6, "m", 0.5)],
                                 "skin_type string, rank bigint, product_name string, score double")
    assert [r["rank"] for r in analysis.dashboard_top(mart).collect()] == [5]
