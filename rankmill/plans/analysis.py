"""Reports over the staging tables and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.operators.quality import SKIN_TYPES

DASHBOARD_RANKS = 5
CATALOG_NAMES = 2000


def regulated_origin(ingredient: DataFrame, regulation: DataFrame) -> DataFrame:
    """Regulated ingredients and prohibited share per origin, from raw snapshot rows.

    The share is taken over ingredient-rule pairs. The pairs are never built: rules and
    ingredient rows are counted per name first and the counts multiplied, so a name with
    many rows on both sides stays one row.
    """
    rules = (
        regulation.where(F.col("INGR_STD_NAME").isNotNull())
        .groupBy("INGR_STD_NAME")
        .agg(
            F.count(F.lit(1)).alias("rules"),
            F.count("PROH_NATIONAL").alias("prohibitions"),
        )
    )
    names = (
        ingredient.where(F.col("INGR_KOR_NAME").isNotNull())
        .groupBy("ORIGIN_MAJOR_KOR_NAME", "INGR_KOR_NAME")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return (
        names.join(rules, names.INGR_KOR_NAME == rules.INGR_STD_NAME)
        .groupBy("ORIGIN_MAJOR_KOR_NAME")
        .agg(
            F.count(F.lit(1)).alias("regulated_ingredients"),
            F.round(
                F.sum(F.col("copies") * F.col("prohibitions"))
                / F.sum(F.col("copies") * F.col("rules")),
                3,
            ).alias("prohibited_ratio"),
        )
        .orderBy(F.desc("regulated_ingredients"), F.col("ORIGIN_MAJOR_KOR_NAME").asc_nulls_last())
    )


def kpi_scorecard(daily: DataFrame) -> DataFrame:
    """Totals over all days. Users active on several days count once per day and type."""
    return daily.agg(
        F.sum("events").alias("events"), F.sum("active_users").alias("active_users")
    )


def dashboard_top(mart: DataFrame, ranks: int = DASHBOARD_RANKS) -> DataFrame:
    return mart.where(F.col("rank") <= ranks).select("skin_type", "rank", "product_name", "score")


def catalog_names(ingredients: DataFrame, limit: int = CATALOG_NAMES) -> DataFrame:
    """Up to `limit` ingredient names, in name order so that reruns agree."""
    return (
        ingredients.where(F.col("ingredient_name_kr").isNotNull())
        .select("ingredient_name_kr")
        .orderBy("ingredient_name_kr")
        .limit(limit)
    )


def topk_match_rate(mart: DataFrame, products: DataFrame, k: int = DASHBOARD_RANKS) -> DataFrame:
    """How often the top `k` fit their segment, next to the share among all pairs.

    A product fits a segment if it targets that segment or `all`. The share over all
    product-segment pairs follows from each product alone: it fits every segment, one, or
    none.
    """
    fits = F.col("target_skin_type").isin("all") | (F.col("target_skin_type") == F.col("skin_type"))
    top = mart.where(F.col("rank") <= k).agg(
        F.struct(
            F.count(F.lit(1)).alias("top_rows"),
            F.round(F.avg(F.coalesce(fits, F.lit(False)).cast("int")), 4).alias("top_match_rate"),
        )
    )
    segments = len(SKIN_TYPES)
    fitted = (
        F.when(F.col("target_skin_type") == "all", segments)
        .when(F.col("target_skin_type").isin(*SKIN_TYPES), 1)
        .otherwise(0)
    )
    every = products.agg(
        (F.count(F.lit(1)) * segments).alias("all_pairs"),
        F.round(F.sum(fitted) / (F.count(F.lit(1)) * segments), 4).alias("random_match_rate"),
    )
    return every.withColumn("top", top.scalar()).select(
        "top.*", "all_pairs", "random_match_rate"
    )
