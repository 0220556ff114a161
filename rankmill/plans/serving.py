"""The served lookup: precomputed ranks, validated parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row

from rankmill.operators.quality import SKIN_TYPES

DEFAULT_LIMIT, MAX_LIMIT = 10, 50

# Served columns and their types.
SERVED = {
    "rank": "bigint",
    "product_id": "string",
    "product_name": "string",
    "category": "string",
    "price_krw": "bigint",
    "score": "double",
    "has_restricted_ingredient": "boolean",
}


def recommend(mart: DataFrame, skin_type: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The best `limit` products of a segment, in rank order.

    Parameters are checked before any query and reach it as bound arguments.
    """
    if skin_type not in SKIN_TYPES:
        raise ValueError(f"unknown segment {skin_type!r}; one of {', '.join(SKIN_TYPES)}")
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be an integer from 1 to {MAX_LIMIT}, got {limit!r}")
    columns = ", ".join(f"cast({name} as {kind}) as {name}" for name, kind in SERVED.items())
    return mart.sparkSession.sql(
        f"select {columns} from {{mart}} where skin_type = :skin_type and rank <= :limit order by rank",
        args={"skin_type": skin_type, "limit": limit},
        mart=mart,
    )


def lookup(mart: DataFrame, skin_type: str, limit: int = DEFAULT_LIMIT) -> list[Row]:
    """`recommend` as rows (at most 50); an empty answer is an error, not an empty list."""
    rows = recommend(mart, skin_type, limit).collect()
    if not rows:
        raise LookupError(f"no recommendations for {skin_type}")
    return rows
