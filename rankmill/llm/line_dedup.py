"""Line dedup with levelled sorted runs of line hashes.

Documents arrive in batches. The keys a batch holds are merge-anti-joined with the runs of all
earlier batches; keys that are new form a run of their own, each with the smallest document id of
the batch that holds it. Runs are tables bucketed and sorted by hash, so the anti join shuffles the
batch only. When a level has `fanout` runs they are merged into one run of the next level, which
keeps the number of runs logarithmic in the number of batches.

A line stays where its key is new and the document is the key's first holder; lines with shorter
keys always stay. Batches that come in id order therefore keep a line in the smallest document id.

A key is identified by 128 bits of hash. A document without an id sorts after all others; rows that
repeat a document id count as one document for the keys. Null and empty texts have one empty line.
A line that a third of all documents hold is one row per map task in the key aggregation; the join
that marks lines has plain exchanges on both sides, so adaptive execution splits such a key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.llm.common import (
    ROW,
    SPACES,
    ascii_lower,
    opened,
    order_id,
    packed,
    remove_dir,
    stored,
    text_of,
    unpacked,
)
from rankmill.session import fresh_dir

MIN_KEY_CHARS = 10
BATCHES = 4
FANOUT = 3
KEY = ["h1", "h2"]


class LineRuns:
    """The runs of one corpus: `levels[k]` lists the tables of level k, newest last."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark = spark
        self.fanout = fanout
        # a bucketed side with fewer buckets than shuffle partitions would be shuffled again
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def tables(self) -> list[tuple[str, str]]:
        return [run for level in self.levels for run in level]

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid.uuid4().hex}", fresh_dir(self.spark, "line-run")
        (
            rows.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", path)
            .format("parquet")
            .saveAsTable(name)
        )
        return name, path

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The keys that no run holds."""
        for name, _ in self.tables():
            keys = keys.join(self.spark.table(name).hint("merge"), KEY, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> DataFrame:
        """Writes unseen keys as a new run and returns it, read as plain files."""
        run = self._write(self.unseen(keys))
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        return self.spark.read.schema(keys.schema).parquet(run[1])

    def compact(self) -> None:
        """Merges full levels upwards. Keys of different runs never repeat."""
        for k, level in enumerate(self.levels):
            if len(level) < self.fanout:
                continue
            merged = self.spark.table(level[0][0])
            for name, _ in level[1:]:
                merged = merged.unionByName(self.spark.table(name))
            run = self._write(merged)
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(run)
            for old in level:
                self._drop(old)
            level.clear()

    def _drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")
        remove_dir(self.spark, run[1])

    def close(self) -> None:
        for run in self.tables():
            self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")


def line_keys(docs: DataFrame) -> DataFrame:
    """One row per line whose key counts: document, its text's hash, position and key hash."""
    key = F.btrim("line", F.lit(SPACES))
    return (
        docs.select(
            order_id().alias("doc"),
            F.xxhash64(text_of()).alias("version"),
            F.posexplode(F.split(ascii_lower(text_of()), "\n", -1)).alias("pos", "line"),
        )
        .select("doc", "version", "pos", key.alias("key"))
        .filter(F.char_length("key") >= MIN_KEY_CHARS)
        .select("doc", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def _batch_of(docs: DataFrame, batches: int) -> Column:
    """Batch number by id range; the bounds come from one pass over the ids."""
    probabilities = F.array(*[F.lit(k / batches) for k in range(1, batches)])
    bounds = docs.agg(F.percentile_approx("doc_id", probabilities, F.lit(1000)).alias("b")).head()["b"] or []
    number = F.lit(0)
    for bound in bounds:
        number = number + (F.col("doc") > F.lit(bound)).cast("int")
    return number.cast("int")


def dropped_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc, version, dropped positions) of documents that lose lines, batch after batch."""
    spark = docs.sparkSession
    numbered = line_keys(docs).withColumn("batch", _batch_of(docs, batches) if batches > 1 else F.lit(0))
    lines = stored(numbered.select("doc", "version", "pos", *KEY, "batch"), "line-keys", "batch")
    runs = LineRuns(spark)
    marked = []
    for k in range(batches):
        batch = lines.filter(F.col("batch") == k)
        fresh = runs.add(batch.groupBy(*KEY).agg(F.min("doc").alias("first_doc")))
        marked.append(
            stored(
                batch.join(fresh, KEY, "left")
                .filter(F.col("first_doc").isNull() | (F.col("first_doc") != F.col("doc")))
                .select("doc", "version", "pos"),
                "line-drops",
            )
        )
        if k + 1 < batches:
            runs.compact()
    runs.close()
    drops = marked[0]
    for more in marked[1:]:
        drops = drops.unionByName(more)
    return drops.groupBy("doc", "version").agg(F.collect_set("pos").alias("gone"))


def deduplicate_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Per row of `docs`: the row as `_row`, `n_lines`, `n_dropped` and `kept_text`."""
    joined = packed(
        docs, text_of().alias("text"), order_id().alias("doc"), F.xxhash64(text_of()).alias("version")
    ).join(dropped_lines(docs, batches), ["doc", "version"], "left")
    none = F.array().cast("array<int>")
    df = opened(
        joined,
        lines=F.when(F.col("gone").isNotNull(), F.split("text", "\n", -1)),
        n_lines=F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1,
    )
    left = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.coalesce("gone", none))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return df.select(
        ROW,
        F.col("n_lines").cast("long").alias("n_lines"),
        F.size(F.coalesce("gone", none)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
    )


def drop_repeated_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """`docs` with the kept lines as text; every document stays, if need be with an empty text."""
    return unpacked(deduplicate_lines(docs, batches), F.col("kept_text"))
