"""SimHash near-dedup by multi-index hashing.

Fingerprint: XXH64 (seed 42) of every word shingle of the A-Z lower-cased text; a bit is set where
more than half of the hashes have it. Fewer words than a shingle: the whole sequence is one shingle;
no words (also null): fingerprint zero, linked like any other.

Index: the 64 bits are cut into segments. Every distinct fingerprint enumerates, segment by
segment, the Hamming ball of radius `distance / 2` around that segment with the other segments left
as they are, and is entered in the index under each resulting word. Two fingerprints that differ in
two bits meet under the word that has one of the two flips, whichever segments the flips are in;
those that differ in one bit meet under either of them. A plain list per segment value would grow
with the square of a group of near copies; under a whole word there are at most 65 fingerprints
(itself and 64 neighbours), however many copies there are, so each entry is a 64-bit mask. Members
of an entry are linked to its smallest one, after their full distance has been verified; members at
distance two of one another thus are connected by at most one further fingerprint of the entry,
which is itself within two bits of both, so components are exactly those of all links.

Documents with one fingerprint are grouped first. Ties, repeated rows and null ids are kept row by
row; a component of null ids only has a null component id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmill.llm.common import LAST_ID, order_id, packed, ship_package, stored, text_of, unpacked
from rankmill.llm.components import component_roots

SEED = 42
DISTANCE = 2
SEGMENTS = 4
#: hashes that are unpacked to bits at once, which bounds the memory of a very long text
CHUNK = 65536


def fingerprint_of(text: str, shingle: int) -> int:
    """Unsigned fingerprint of one text. `bytes.lower` and `bytes.split` know ASCII only."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    last = max(len(words) - shingle, 0) + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, last, CHUNK):
        hashes = np.array(
            [digest(join(words[i : i + shingle]), SEED) for i in range(start, min(start + CHUNK, last))], dtype="<u8"
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > last).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """Signed 64-bit fingerprint column."""

    @F.pandas_udf("bigint")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = np.array([fingerprint_of(t, shingle) for t in batch], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return compute(text)


def hex_of(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _flip(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def _index(prints: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """Entries with two members or more: the word, the mask of flipped bits that lead to its
    members, and whether the word itself is a member."""
    width = 64 // segments
    balls = [
        F.transform(
            F.sequence(F.lit(s * width), F.lit((s + 1) * width - 1)),
            lambda bit: F.struct(F.col("fp").bitwiseXOR(_flip(bit)).alias("word"), bit.alias("bit")),
        )
        for s in range(segments)
    ]
    itself = F.array(F.struct(F.col("fp").alias("word"), F.lit(-1).alias("bit")))
    entries = prints.select(F.explode(F.concat(itself, *balls)).alias("e")).select("e.word", "e.bit")
    flips = F.when(F.col("bit") >= 0, _flip(F.col("bit"))).otherwise(F.lit(0).cast("long"))
    return (
        entries.groupBy("word")
        .agg(F.bit_or(flips).alias("mask"), F.min("bit").alias("least_bit"))
        .filter(F.bit_count("mask") + (F.col("least_bit") < 0).cast("int") >= 2)
    )


def fingerprint_links(prints: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """Verified links (a, b) that connect all distinct fingerprints `fp` within two bits."""
    flips = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda bit: F.col("mask").bitwiseAND(_flip(bit)) != 0)
    members = F.concat(
        F.transform(flips, lambda bit: F.col("word").bitwiseXOR(_flip(bit))),
        F.when(F.col("least_bit") < 0, F.array("word")).otherwise(F.array().cast("array<bigint>")),
    )
    return (
        _index(prints, segments)
        .select(members.alias("members"))
        .select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
        .filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))
        .distinct()
    )


def _grouped(printed: DataFrame) -> DataFrame:
    """Adds `root` and `component_id` to a stored table with `id` (never null) and `fp`."""
    groups = stored(printed.groupBy("fp").agg(F.min("id").alias("first_id")), "fingerprint-groups")
    roots = component_roots(fingerprint_links(groups.select("fp")))
    member = stored(
        groups.join(roots, groups["fp"] == roots["node"], "left").select(
            groups["fp"], "first_id", F.coalesce("root", groups["fp"]).alias("root")
        ),
        "members",
    )
    least = stored(member.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    named = stored(member.join(least, "root").select("fp", "root", "component_id"), "component-names")
    return printed.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp signed, component_id) per row of `docs`."""
    ship_package(docs.sparkSession)
    printed = stored(docs.select("doc_id", order_id().alias("id"), fingerprint(text_of(), shingle).alias("fp")), "fingerprints")
    return _grouped(printed).select("doc_id", "fp", F.nullif("component_id", F.lit(LAST_ID)).alias("component_id"))


def keep_first_copies(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One document of each component of `near_duplicates`: the one with the smallest id.

    Documents without words share fingerprint zero, so one of them stays. Rows that repeat the kept
    document's id and text stay with it; of other texts under its id, one of the component stays. Rows
    without an id count as the largest: one text of them stays if no numbered document is in their component.
    Texts may be of any length, and further columns may have any name.
    """
    ship_package(docs.sparkSession)
    keys = [order_id().alias("id"), F.xxhash64(text_of()).alias("version")]
    printed = stored(docs.select(*keys, fingerprint(text_of(), shingle).alias("fp")), "fingerprints")
    smallest = _grouped(printed).filter(F.col("id") == F.col("component_id"))
    first = smallest.groupBy("root").agg(F.min("id").alias("id"), F.min("version").alias("version")).drop("root")
    return unpacked(packed(docs, *keys).join(first, ["id", "version"], "left_semi"))
