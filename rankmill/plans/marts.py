"""Marts: recommendations per segment, and daily activity."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.functions.scalars import composite_key
from rankmill.operators.joins import BROADCAST_ROWS, join_lookup
from rankmill.operators.ranking import ROWS_PER_SORT_TASK, rank_within


class Weights(NamedTuple):
    """Points per view, like and purchase, and the factor of the average rating."""

    view: int = 1
    like: int = 3
    purchase: int = 5
    rating: int = 2


def product_risk(
    products: DataFrame,
    regulation: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    regulation_rows: int | None = None,
) -> DataFrame:
    """Per product with a regulated ingredient: does any rule prohibit or restrict it?

    Rules are folded to one row per ingredient before the join. OR does not care how often
    a rule is repeated, so this is exact, and an ingredient with very many rules no longer
    multiplies the products that contain it. The rows of the regulation list bound the
    folded rules; an ingredient found in very many products is dealt with by the join. Where
    `regulation_rows` is known, as the load counted them, nothing is counted here.
    """
    rules = regulation.groupBy(F.col("ingredient_std_name").alias("ingredient_name")).agg(
        F.bool_or(F.col("prohibited_in_country").isNotNull()).alias("prohibited"),
        F.bool_or(F.col("restricted_in_country").isNotNull()).alias("restricted"),
    )
    contents = products.select(
        "product_id", F.explode(F.array_distinct("key_ingredients")).alias("ingredient_name")
    )
    regulated = join_lookup(
        contents,
        rules,
        "ingredient_name",
        lookup_rows_bound=regulation.count() if regulation_rows is None else regulation_rows,
        spread_by="product_id",
        broadcast_rows=broadcast_rows,
    )
    return (
        regulated.groupBy("product_id")
        .agg(
            F.bool_or("prohibited").alias("has_prohibited_ingredient"),
            F.bool_or("restricted").alias("has_restricted_ingredient"),
        )
    )


def _activity(events: DataFrame, keys: list[str]) -> DataFrame:
    kind = F.col("event_type")
    views, likes, purchases = (F.count_if(kind == k) for k in ("view", "like", "purchase"))
    return events.groupBy(*keys).agg(
        views.alias("views"),
        likes.alias("likes"),
        purchases.alias("purchases"),
        F.avg("rating").alias("avg_rating"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("ratings"),
    )


def _scored(counts: DataFrame, weights: Weights) -> DataFrame:
    score = (
        F.col("views") * weights.view
        + F.col("likes") * weights.like
        + F.col("purchases") * weights.purchase
        + F.coalesce("avg_rating", F.lit(0.0)) * weights.rating
    )
    return counts.select(
        "skin_type", "product_id", "views", "likes", "purchases", "avg_rating", score.alias("score")
    )


def skin_product_scores(events: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """Behaviour counts and score per segment and product."""
    return _scored(_activity(events, ["skin_type", "product_id"]), weights)


def daily_activity(events: DataFrame, day: str = "dt") -> DataFrame:
    """Additive behaviour counts per day, segment and product.

    Days of unchanged events need not be read again: the scores follow from these sums.
    """
    return _activity(events, [day, "skin_type", "product_id"]).drop("avg_rating")


def scores_from_activity(activity: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """`skin_product_scores`, from daily sums instead of events."""
    sums = ("views", "likes", "purchases", "rating_sum", "ratings")
    totals = activity.groupBy("skin_type", "product_id").agg(*[F.sum(c).alias(c) for c in sums])
    return _scored(totals.withColumn("avg_rating", F.try_divide("rating_sum", "ratings")), weights)


def recommendations(
    events: DataFrame,
    products: DataFrame,
    regulation: DataFrame,
    weights: Weights = Weights(),
    rows_per_task: int = ROWS_PER_SORT_TASK,
) -> DataFrame:
    """Ranked products per segment, from the cleaned events."""
    return rank_products(skin_product_scores(events, weights), products, regulation, rows_per_task)


def rank_products(
    scores: DataFrame,
    products: DataFrame,
    regulation: DataFrame,
    rows_per_task: int = ROWS_PER_SORT_TASK,
    loaded: Mapping[str, int] | None = None,
) -> DataFrame:
    """Filter scored products by regulation and rank what remains.

    Prohibited ingredients exclude a product for everyone, restricted ones only for the
    segment `sensitive`. Ranks are given after that, so they have no gaps; equal scores
    are ordered by product id.

    A segment has at most one row per catalog row, so the size of the catalog bounds the
    rows a rank sorts in one task. `loaded` has the rows of the `products` and `regulation` snapshots
    if their loads have counted them; the models have no more rows than that.
    """
    known = loaded or {}
    catalog = products.select(
        "product_id", "product_name", "category", "target_skin_type", "price_krw"
    )
    prohibited = F.coalesce("has_prohibited_ingredient", F.lit(False))
    restricted = F.coalesce("has_restricted_ingredient", F.lit(False))
    allowed = (
        scores.join(catalog, "product_id")
        .join(product_risk(products, regulation, regulation_rows=known.get("regulation")), "product_id", "left")
        .where(~prohibited)
        .where(~((F.col("skin_type") == "sensitive") & restricted))
        .withColumn("has_restricted_ingredient", restricted)
    )
    ranked = rank_within(
        allowed,
        ["skin_type"],
        [F.desc("score"), F.asc("product_id")],
        "rank",
        group_rows_bound=known["products"] if "products" in known else catalog.count(),
        rows_per_task=rows_per_task,
    )
    return ranked.select(
        "skin_type",
        "product_id",
        "product_name",
        "category",
        "target_skin_type",
        "price_krw",
        "views",
        "likes",
        "purchases",
        F.round("avg_rating", 2).alias("avg_rating"),
        F.round("score", 2).alias("score"),
        "has_restricted_ingredient",
        "rank",
        composite_key(F.col("skin_type"), F.col("product_id")).alias("rec_key"),
    )


def events_daily(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Activity per UTC day and event type.

    Exact distinct counts are aggregated by user and by product first, so a day that holds
    a large share of the events still spreads over all tasks. `approximate` replaces them
    by sketches, which saves that pass.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return events.groupBy(F.to_date("event_ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        distinct("user_id").alias("active_users"),
        distinct("product_id").alias("touched_products"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
    )
