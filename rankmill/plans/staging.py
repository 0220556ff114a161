"""Staging models: newest snapshot, readable names, right types, no duplicates.

Each model is a function of the raw DataFrame and stays lazy, so it works as a view.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.functions.scalars import (
    padded_id,
    parse_json_text,
    safe_compact_date,
    scalar_or_null,
)
from rankmill.operators.dedup import first_per_key, remaining_order
from rankmill.operators.snapshot import latest_snapshot
from rankmill.sources.schemas import EVENT_FIELDS

AsOf = dt.date | str | None

BUSINESS_NUMBER_WIDTH = 10


def stg_ingredient(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row per ingredient name; a row with an English name wins over one without."""
    renamed = latest_snapshot(raw, as_of).select(
        F.col("INGR_KOR_NAME").alias("ingredient_name_kr"),
        F.col("INGR_ENG_NAME").alias("ingredient_name_en"),
        F.col("INGR_SYNONYM").alias("synonyms"),
        F.col("CAS_NO").alias("cas_no"),
        F.col("ORIGIN_MAJOR_KOR_NAME").alias("origin_major_kr"),
    )
    # remaining_order starts with the English name, NULLs last, and goes on to break ties
    return first_per_key(
        renamed, ["ingredient_name_kr"], remaining_order(renamed, ["ingredient_name_kr"])
    )


def stg_regulation(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Ingredient and country rule. Several rows per ingredient are normal.

    An empty country text is a value and not NULL, so it counts as prohibited.
    """
    return latest_snapshot(raw, as_of).select(
        F.col("INGR_STD_NAME").alias("ingredient_std_name"),
        F.col("INGR_ENG_NAME").alias("ingredient_name_en"),
        F.col("PROH_NATIONAL").alias("prohibited_in_country"),
        F.col("LIMIT_NATIONAL").alias("restricted_in_country"),
        F.col("PROH_NATIONAL").isNotNull().alias("is_prohibited_anywhere"),
    )


def stg_manufacturer(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row per company: identifiers as text, permit date as a date."""
    renamed = latest_snapshot(raw, as_of).select(
        F.col("ENTP_SEQ").cast("string").alias("company_seq"),
        F.col("ENTP_NAME").alias("company_name"),
        F.col("BOSS_NAME").alias("ceo_name"),
        F.col("INDUTY").alias("industry"),
        F.col("FACTORY_ADDR").alias("factory_address"),
        padded_id(F.col("BIZRNO"), BUSINESS_NUMBER_WIDTH).alias("business_reg_no"),
        safe_compact_date(F.col("ENTP_PERMIT_DATE")).alias("permit_date"),
    )
    return first_per_key(renamed, ["company_seq"], remaining_order(renamed, ["company_seq"]))


def stg_products(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return latest_snapshot(raw, as_of).select(
        "product_id", "product_name", "category", "target_skin_type", "price_krw", "key_ingredients"
    )


FULL_DATE = "^[ ]*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([^0-9]|$)"


def parsed_events(raw: DataFrame) -> DataFrame:
    """Typed payload of every message that carries an event id, copies included.

    A bad time stamp or rating becomes NULL instead of failing the whole read; a NULL
    event date is caught by the checks.
    """
    # inline() opens the struct in a generator. A filter on a field does not move below
    # it, so the text is parsed once per message and not once more for each condition.
    payload = F.inline(F.array(parse_json_text(F.col("data"), EVENT_FIELDS)))
    field = {name: scalar_or_null(name) for name in EVENT_FIELDS}
    return (
        raw.select("publish_time", payload)
        .where(f"{field['event_id']} is not null")
        .selectExpr(
            f"{field['event_id']} as event_id",
            f"{field['event_type']} as event_type",
            # time or year alone would be completed with today's date or January
            f"if({field['event_ts']} rlike '{FULL_DATE}', try_to_timestamp({field['event_ts']}), null) as event_ts",
            f"{field['user_id']} as user_id",
            f"{field['skin_type']} as skin_type",
            f"{field['product_id']} as product_id",
            f"{field['session_id']} as session_id",
            f"try_cast({field['rating']} as bigint) as rating",
            "publish_time",
        )
    )


def stg_events(raw: DataFrame) -> DataFrame:
    """One row per event id: the copy that was published first.

    Copies published at the same moment are told apart by their columns, so the result
    does not depend on the arrival order.
    """
    events = parsed_events(raw)
    order = [F.col("publish_time").asc_nulls_first()]
    order += remaining_order(events, ["event_id", "publish_time"])
    return first_per_key(events, ["event_id"], order)
