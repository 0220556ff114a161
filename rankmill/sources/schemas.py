"""Fixed schemas of the raw tables and the registry of sources.

Identifiers are strings on purpose: read as numbers they would lose leading zeros.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INGREDIENT = T.StructType(
    [
        T.StructField("INGR_KOR_NAME", T.StringType()),
        T.StructField("INGR_ENG_NAME", T.StringType()),
        T.StructField("INGR_SYNONYM", T.StringType()),
        T.StructField("CAS_NO", T.StringType()),
        T.StructField("ORIGIN_MAJOR_KOR_NAME", T.StringType()),
    ]
)

REGULATION = T.StructType(
    [
        T.StructField("INGR_STD_NAME", T.StringType()),
        T.StructField("INGR_ENG_NAME", T.StringType()),
        T.StructField("PROH_NATIONAL", T.StringType()),
        T.StructField("LIMIT_NATIONAL", T.StringType()),
    ]
)

MANUFACTURER = T.StructType(
    [
        T.StructField("ENTP_SEQ", T.StringType()),
        T.StructField("ENTP_NAME", T.StringType()),
        T.StructField("BOSS_NAME", T.StringType()),
        T.StructField("INDUTY", T.StringType()),
        T.StructField("FACTORY_ADDR", T.StringType()),
        T.StructField("BIZRNO", T.StringType()),
        T.StructField("ENTP_PERMIT_DATE", T.StringType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("target_skin_type", T.StringType()),
        T.StructField("price_krw", T.LongType()),
        T.StructField("key_ingredients", T.ArrayType(T.StringType())),
    ]
)

EVENT_MESSAGE = T.StructType(
    [
        T.StructField("subscription_name", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("publish_time", T.TimestampType()),
        T.StructField("data", T.StringType()),
        T.StructField("attributes", T.StringType()),
    ]
)

# Field names of the event payload, version 1.
EVENT_FIELDS = (
    "event_id",
    "event_type",
    "event_ts",
    "user_id",
    "skin_type",
    "product_id",
    "session_id",
    "rating",
)


@dataclass(frozen=True)
class Source:
    name: str
    schema: T.StructType


# Master lists pulled in full every day.
SOURCES = {
    s.name: s
    for s in (
        Source("ingredient", INGREDIENT),
        Source("regulation", REGULATION),
        Source("manufacturer", MANUFACTURER),
    )
}

# All daily snapshot tables: the master lists plus the product catalog.
SNAPSHOTS = {
    **SOURCES,
    "products": Source("products", PRODUCTS),
}

# Event messages appended in batches, and those that the landing stream writes.
EVENTS, STREAMED = "events", "events_stream"


def pick(source: str) -> list[Source]:
    """The sources a `--source` style argument names: one of them, or `all`."""
    if source == "all":
        return list(SOURCES.values())
    if source not in SNAPSHOTS:
        raise ValueError(f"unknown source {source!r}; choose from all, {', '.join(SNAPSHOTS)}")
    return [SNAPSHOTS[source]]


def with_partition(schema: T.StructType, dt_col: str = "dt") -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(dt_col, T.DateType())])
