"""A training corpus from raw documents, in five stages; each stage works on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet in the
shared folder and reads it back as the next one's docs. All but the last return the columns of
`documents`; the last adds what the mix takes of each document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankmill.llm.common import documents, stored
from rankmill.llm.decontam import drop_leaked
from rankmill.llm.line_dedup import drop_repeated_lines
from rankmill.llm.mixing import mixed_documents
from rankmill.llm.quality import clean_documents
from rankmill.llm.simhash import keep_first_copies

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: failing lines go, then documents that the rules reject."""
    return clean_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: repeated lines stay in the smallest document id only."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near copies stays."""
    return keep_first_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold an item of the benchmark go."""
    return drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: what the mix takes of each document; those it takes nothing of go."""
    return mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

# XXH64 fingerprints and their components are beyond SQL; the tests hold a brute-force version
# against `run`.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
