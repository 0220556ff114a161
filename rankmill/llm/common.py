"""Expressions and small table helpers that several operators share.

Word, line and letter-case rules are those of the digests: white space is `[\\x20\\x09-\\x0D]`,
only A-Z change case. A null text counts as an empty one everywhere.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import rankmill
from rankmill.session import fresh_dir, shared_dir

SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LAST_ID = 2**63 - 1
ROW = "_row"
BLOCK = 128  # elements folded at a time by `with_running`


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """The whole input row as one struct beside the named columns, so that no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), *columns)


def unpacked(df: DataFrame, text: Column | None = None) -> DataFrame:
    """The rows that `packed` wrapped; `text` replaces their text where given."""
    fields = df.schema[ROW].dataType.fieldNames()
    return df.select(
        *[
            text.alias(name) if text is not None and name == "text" else F.col(f"{ROW}.`{name}`").alias(name)
            for name in fields
        ]
    )


def order_id(name: str = "doc_id") -> Column:
    """A document without an id comes after all others."""
    return F.coalesce(F.col(name), F.lit(LAST_ID))


def words(text: Column) -> Column:
    """`[^\\x20\\x09-\\x0D]+` of a text that is not null, in order."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE_CLASS}+"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. `lower` does just that where every character is one byte."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def opened(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once each.

    They pass through a one-row generator: Catalyst would otherwise copy an expression into a
    lambda that uses its column and evaluate it again for every element.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.explode(F.array(values)).alias("_opened")).select(
        *[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_opened.{name}").alias(name) for name in columns]
    )


def _scan(values: Column, first: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """`first` and what it becomes with each value; copies its result per value, so for short arrays only."""
    return F.aggregate(values, F.array(first), lambda out, v: F.concat(out, F.array(combine(F.element_at(out, -1), v))))


def with_running(
    df: DataFrame, values: dict[str, Column], combine: Callable[[Column, Column], Column] = lambda a, b: a + b
) -> DataFrame:
    """Adds per name the running sum (or other fold from zero) of an integer array, BLOCK values at a time."""

    def blocks(name: str) -> Column:
        last = F.greatest(F.ceil(F.size(name) / BLOCK).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(name, k * BLOCK + 1, BLOCK))

    def before(name: str) -> Column:
        totals = F.transform(F.col(f"{name}_blocks"), lambda block: F.aggregate(block, F.lit(0), combine))
        return _scan(totals, F.lit(0), combine)

    def folded(name: str) -> Column:
        start = F.col(f"{name}_before")
        return F.flatten(
            F.transform(f"{name}_blocks", lambda block, k: F.slice(_scan(block, F.get(start, k), combine), 2, BLOCK))
        )

    df = opened(df, **values)
    df = opened(df, **{f"{name}_blocks": blocks(name) for name in values})
    df = opened(df, **{f"{name}_before": before(name) for name in values})
    rest = [c for c in df.columns if c not in values]
    df = opened(df.withColumnsRenamed({name: f"{name}_values" for name in values}), **{name: folded(name) for name in values})
    return df.select(*[c for c in rest if not c.endswith(("_blocks", "_before"))], *values)


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Writes a table in the shared folder and reads it back; what follows starts from its files."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def span_text(spans: Column) -> Column:
    """`kind:start:end` of an array of spans, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def remove_dir(spark: SparkSession, path: str) -> None:
    """Removes a folder of this library below the shared one."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"not below the shared folder: {path}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def ship_package(spark: SparkSession) -> None:
    """Sends this package's modules to the executors, once per application, for Python functions.

    Spark's own file server does it, as with `--py-files`; nothing has to be installed there.
    """
    context = spark.sparkContext
    if getattr(context, "_rankmill_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(rankmill.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="rankmill-code-"), "rankmill_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    context._rankmill_shipped = True
