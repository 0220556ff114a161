"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, and share 150 % of all
words. A source whose share is above twice its size stops there; the excess goes to the others by
weight until none is above.

Taking: a target holds `floor(target / source size)` complete epochs of every document and a rest.
For the rest each document draws the key -ln(u) / quality, with u from the hash of its id and text, so a rerun
draws the same. Documents are taken by rising key until their prefix sum meets the rest; the one
that crosses it is cut to what is missing. So a source takes exactly its target, rounded down.

The order within a source is never sorted as a whole. Keys are cut into `BUCKETS` ranges; sums per
source and range, combined in the map tasks, give the range in which the rest ends. Only that range
is sorted: of a source with a third of all rows it holds a few rows in a thousand.

Null text: no words. Sizes of zero take nothing. Equal keys are ordered by id, then text hash; rows
that repeat both draw the same key and are told apart by a running number of their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankmill.llm.common import ROW, order_id, packed, stored, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
BUCKETS = 4096
SYMBOLS = r"[#*$%&|<>]"


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def quality_of(text: Column) -> Column:
    """Document quality weight in (0, 1]: one for plain prose, less the more symbols it holds."""
    return F.lit(1.0) / (
        F.lit(1.0)
        + F.lit(20.0) * F.regexp_count(text, F.lit(SYMBOLS)) / F.greatest(F.char_length(text), F.lit(1))
    )


def sampling_key(doc_id: Column, text: Column) -> Column:
    """-ln(u) / quality; u in (0, 1) from 48 bits of a hash of the id and the text."""
    seed = F.md5(F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(text.cast("binary"))).cast("binary"))
    u = (F.conv(F.substring(seed, 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)
    return -F.log(u) / quality_of(text)


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: `source`, `source_size`, `target`. Works on one row per source only.

    Sources stop in the order of 2 * size / weight: with the k smallest stopped, the others get
    (total - stopped) / (remaining weight) per weight; the right k is the first at which the next
    source stays within its stop.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), place + 1).cast("long")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).select("*", weight.alias("weight"))
    stop = F.col("source_size") * MOST_EPOCHS
    by_stop = everything.orderBy(stop / F.col("weight"), F.col("source").isNull(), F.col("source"))
    earlier = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(SHARE)).alias("total"),
        F.coalesce(F.sum(stop).over(earlier), F.lit(0)).alias("stopped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))).alias("rest_weight"),
    )
    per_weight = (F.col("total") - F.col("stopped")) / F.col("rest_weight")
    sources = sources.withColumn("per_weight", F.when(F.col("weight") * per_weight <= stop, per_weight))
    # the level rises with every source that has to stop and falls with every one that has not
    level = F.max("per_weight").over(everything)
    return sources.select(
        "source",
        "source_size",
        F.least(stop.cast("double"), F.coalesce(F.col("weight") * level, stop.cast("double"))).alias("target"),
    )


def _drawn() -> list[Column]:
    text = text_of()
    return [
        order_id().alias("id"),
        F.col("source"),
        size_of(text).alias("size"),
        F.xxhash64(text).alias("version"),
        sampling_key(F.col("doc_id"), text).alias("key"),
    ]


def mix_plan(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row; texts are read once."""
    return _taken(stored(docs.select("doc_id", *_drawn()), "mix-draws"))


def mix_sources(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: the row as `_row`, `size`, `source_size`, `target` and `taken`."""
    return _taken(packed(docs, *_drawn()))


def _taken(drawn: DataFrame) -> DataFrame:
    bucket = F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    drawn = drawn.withColumn("bucket", bucket)
    sums = stored(drawn.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "mix-sums")
    targets = stored(source_targets(sums), "mix-targets")
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    spans = (
        sums.alias("s")
        .join(targets.alias("t"), same)
        .select("s.*", "source_size", "target")
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .select(
            "*", rest.alias("rest"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead")
        )
        .filter((F.col("ahead") < F.col("rest")) | (F.col("ahead") == 0))
    )
    # one row per source: the bucket in which its rest ends, and the words of all buckets before
    edge = stored(
        spans.groupBy("source").agg(
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
            F.first("epochs").alias("epochs"),
            F.first("rest").alias("rest"),
            F.max(F.struct("bucket", "ahead")).alias("edge"),
        ),
        "mix-edges",
    )
    placed = (
        drawn.alias("d")
        .join(edge.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")))
        .select("d.*", "source_size", "target", "epochs", "rest", "edge")
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "version")
    at_edge = F.col("bucket") == F.col("edge.bucket")
    ahead = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    cut = placed.filter(at_edge).withColumn("ahead", F.col("edge.ahead") + F.coalesce(ahead, F.lit(0)))
    sure = placed.filter(~at_edge).withColumn(
        "ahead", F.when(F.col("bucket") < F.col("edge.bucket"), F.lit(0)).otherwise(F.col("rest"))
    )
    part = F.when(F.col("bucket") < F.col("edge.bucket"), F.col("size")).otherwise(
        F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("ahead")))
    )
    kept = [c for c in (ROW, "doc_id") if c in drawn.columns]
    return cut.unionByName(sure).select(
        *kept, "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The last stage: every document with at least one taken word, and how many are taken.

    An added column whose name `docs` has already, in any case, is called `mix_...`, with as many `mix_` as
    it takes to be free; so the stage can work on its own result.
    """
    mixed = mix_sources(docs).filter(F.col("taken") > 0)
    fields = mixed.schema[ROW].dataType.fieldNames()
    held, added = {f.lower() for f in fields}, []
    for column in ("size", "source_size", "target", "taken"):
        name = column
        while name.lower() in held:
            name = f"mix_{name}"
        held.add(name.lower())
        added.append(F.col(column).alias(name))
    return mixed.select(*[F.col(f"{ROW}.`{f}`").alias(f) for f in fields], *added)
