"""Checks of a table partitioned by date, of which only changed dates are read again.

The ledger of a table has a row per date: the digest of its files, its rows, and the violations of
each check that concerns single rows. Beside it stands the list of repeated keys, which is
empty while the uniqueness check holds. A later check reads the dates whose files differ, counts their
keys together with those of the list, and looks up only these keys in the other dates. The result
equals a check of the whole table.

Ledger and list are written to a new folder and switched to by a note, so a failed check changes nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.operators.quality import CHECKS, UNIQUE, Check, breaks, report_line
from rankmill.sources.lake import Lake, held_dates, in_dates, partition_files
from rankmill.sources.notes import note_number, read_note, write_note

STAGING = "staging"
LEDGER_SCHEMA = "dt date, files string, n bigint, violations array<bigint>"


def _digests(spark: SparkSession, lake: Lake, path: str) -> dict[dt.date | None, str]:
    files = partition_files(spark, path, held_dates(spark, lake, path))
    return {day: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for day, names in files.items()}


def check_history(
    spark: SparkSession, lake: Lake, name: str, schema: str, checks: Sequence[Check] = CHECKS, layer: str = STAGING
) -> DataFrame:
    """The report lines of one date-partitioned table, as `quality_report` gives them.

    `schema` is that of the table with its partition column `dt`; one of the checks may be for
    uniqueness.
    """
    own = [c for c in checks if c.model == name]
    by_row = [c for c in own if c.kind != UNIQUE]
    (key,) = {c.column for c in own if c.kind == UNIQUE} or {None}
    path, notes = lake.table(name, layer), lake.table(f"{name}_checks", layer)
    number, note = note_number(spark, notes), read_note(spark, notes)
    declared = [f"{c.column} {c.kind} {','.join(c.values)}" for c in own]
    if note and note["checks"] != declared:
        note = None  # other checks than last time: nothing of it can be used

    now = _digests(spark, lake, path)
    folder = f"{notes}/{uuid.uuid4().hex}"
    table = spark.read.schema(schema).parquet(path) if now else spark.createDataFrame([], schema)
    if note:
        ledger = spark.read.schema(LEDGER_SCHEMA).parquet(f"{note['folder']}/ledger")
        seen = {r.dt: r.files for r in ledger.select("dt", "files").collect()}
        repeated = spark.read.schema("key string, copies bigint").parquet(f"{note['folder']}/repeated")
    else:
        ledger, seen, repeated = None, {}, None
    changed = {day for day in now.keys() | seen.keys() if now.get(day) != seen.get(day)}
    if note and not changed:
        return _report(own, ledger, repeated)

    fresh = table.where(in_dates(changed))
    counts = fresh.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.count_if(breaks(c)) for c in by_row]).cast("array<bigint>").alias("violations"),
    )
    files = spark.createDataFrame([(d, f) for d, f in now.items() if d in changed], "dt date, files string")
    lines = files.join(F.broadcast(counts), files["dt"].eqNullSafe(counts["dt"]), "left").select(
        files["dt"], "files", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        F.coalesce("violations", F.array(*[F.lit(0).cast("bigint") for _ in by_row]).cast("array<bigint>")).alias("violations"),
    )
    if ledger is not None:
        lines = lines.unionByName(ledger.where(~F.coalesce(in_dates(changed), F.lit(False))))
    lines.coalesce(1).write.parquet(f"{folder}/ledger")

    if key:
        keyed = fresh.select(F.col(key).alias("key")).where("key is not null")
        copies = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
        rest = now.keys() - changed
        if rest:
            asked = copies.select("key").unionAll(repeated.select("key")).distinct()
            others = table.where(in_dates(rest)).select(F.col(key).alias("key")).join(asked, "key", "left_semi")
            older = others.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
            copies = copies.unionByName(older).groupBy("key").agg(F.sum("copies").alias("copies"))
        copies.where("copies > 1").write.parquet(f"{folder}/repeated")
    else:
        spark.createDataFrame([], "key string, copies bigint").write.parquet(f"{folder}/repeated")
    write_note(spark, notes, {"folder": folder, "checks": declared}, after=number)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(f"{folder}/ledger")
    return _report(own, ledger, spark.read.schema("key string, copies bigint").parquet(f"{folder}/repeated"))


def _report(own: Sequence[Check], ledger: DataFrame, repeated: DataFrame) -> DataFrame:
    """One line per check: sums over the ledger, and the length of the list."""
    by_row = [c for c in own if c.kind != UNIQUE]
    none = F.lit(0).cast("bigint")
    counted = ledger.select(*[F.col("violations")[n].alias(f"v{n}") for n in range(len(by_row))], none.alias("repeated"))
    listed = repeated.select(*[none.alias(f"v{n}") for n in range(len(by_row))], F.lit(1).cast("bigint").alias("repeated"))
    both = counted.unionByName(listed)
    totals = both.agg(*[F.coalesce(F.sum(c), none).alias(c) for c in both.columns])
    place = {c: f"v{n}" for n, c in enumerate(by_row)}
    return totals.select(F.inline(F.array(*[report_line(c, F.col(place.get(c, "repeated"))) for c in own])))


def repeated_keys(spark: SparkSession, lake: Lake, name: str, layer: str = STAGING) -> DataFrame:
    """(key, copies) of the keys that the last check found more than once."""
    note = read_note(spark, lake.table(f"{name}_checks", layer))
    return spark.read.schema("key string, copies bigint").parquet(f"{note['folder']}/repeated")


def check_ledger(spark: SparkSession, lake: Lake, name: str, layer: str = STAGING) -> DataFrame:
    """(dt, files, n, violations) of the last check."""
    note = read_note(spark, lake.table(f"{name}_checks", layer))
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{note['folder']}/ledger")
