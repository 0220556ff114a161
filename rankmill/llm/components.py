"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is one aggregation and one join and is written to the shared folder, so lineage stays
short and a lost executor costs one step. Nothing about single nodes reaches the driver: it sees a
row count and a checksum per round. The least neighbours are written before they are joined, so
both sides of the join are plain exchanges and adaptive execution can split a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.llm.common import stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).head())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")), "large-star")
    return (
        both.filter(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("hi").agg(F.min("lo").alias("m")), "small-star")
    others = (
        edges.join(least, "hi").filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    )
    return others.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); the root is the component's smallest node.

    Loops are ignored, so a node that has only a loop is not listed.
    """
    apart = edges.filter(F.col("a") != F.col("b"))
    current = stored(apart.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    before = _signature(current)
    while before[0]:
        current = stored(_small_star(stored(_large_star(current), "edges")), "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        current.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
