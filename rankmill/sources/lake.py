"""Date-partitioned lake: JSON-lines landing area, Parquet layers, retention.

    {root}/raw/{source}/dt=YYYY-MM-DD/          landed snapshots, JSON lines
    {root}/warehouse/{layer}/{table}/[dt=...]   Parquet tables
    {root}/warehouse/{layer}/versions/{id}/     tables that are rebuilt as a whole, published by a note
    {root}/labs/{report}/dt=YYYY-MM-DD/         one-off reports
    {root}/runs/dt=YYYY-MM-DD/                  which stages of a day's run are done

A date of a snapshot table is loaded aside, audited and then moved into place; `_staged` and
`_replaced` below a table hold what is on its way in or out, and Spark does not read them.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from collections.abc import Callable, Collection, Iterable, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankmill.session import run_together
from rankmill.sources.notes import note_number, read_note, write_note
from rankmill.sources.schemas import (
    EVENT_MESSAGE,
    EVENTS,
    SNAPSHOTS,
    STREAMED,
    pick,
    with_partition,
)

RETENTION_DAYS = 90

# Fixed value: the folder Spark writes rows without a partition date to.
NO_DATE = "dt=__HIVE_DEFAULT_PARTITION__"

STAGED, REPLACED = "_staged", "_replaced"
KEPT_VERSIONS = 3
# Small row groups: a lookup of the first ranks reads the first one of a segment.
ROW_GROUP_BYTES = 2**20

Audit = Callable[[DataFrame], None]


class EmptySnapshotError(RuntimeError):
    """A snapshot without rows is refused: it would hide a failed pull downstream."""


def as_date(day: dt.date | str) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(day)


def partition_address(table: str, day: dt.date | str) -> str:
    """`table$YYYYMMDD`, the compact name of one daily partition."""
    return f"{table}${as_date(day):%Y%m%d}"


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def list_folder(spark: SparkSession, path: str) -> list:
    """File statuses of a folder; none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.listStatus(folder)) if fs.exists(folder) else []


def _folders(spark: SparkSession, path: str) -> list[str]:
    names = [status.getPath().getName() for status in list_folder(spark, path)]
    return [name for name in names if name.startswith("dt=")]


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def date_folder(day: dt.date | None) -> str:
    return NO_DATE if day is None else f"dt={day.isoformat()}"


def in_dates(dates: Iterable[dt.date | None], column: str = "dt") -> Column:
    """Rows of the given partition dates; None stands for rows without one."""
    known = sorted(d for d in set(dates) if d is not None)
    inside = F.col(column).isin(known) if known else F.lit(False)
    return F.col(column).isNull() | inside if None in set(dates) else inside


@dataclass(frozen=True)
class Lake:
    """Paths of one lake. A named layer is used as it is, no layer means the default."""

    root: str
    default_layer: str = "staging"

    def landing(self, source: str) -> str:
        return f"{self.root}/raw/{source}"

    def snapshot(self, source: str, day: dt.date | str) -> str:
        return f"{self.landing(source)}/dt={as_date(day).isoformat()}"

    def table(self, name: str, layer: str | None = None) -> str:
        return f"{self.root}/warehouse/{layer.strip() if layer else self.default_layer}/{name}"

    def report(self, name: str, day: dt.date | str) -> str:
        return f"{self.root}/labs/{name}/dt={as_date(day).isoformat()}"

    def version(self, name: str, version: str, layer: str) -> str:
        return f"{self.root}/warehouse/{layer}/versions/{version}/{name}"

    def run(self, day: dt.date | str) -> str:
        return f"{self.root}/runs/dt={as_date(day).isoformat()}"

    def dates(self, spark: SparkSession, path: str) -> list[dt.date]:
        """Partition dates of a table, from one directory listing (no file is opened)."""
        names = [name for name in _folders(spark, path) if name != NO_DATE]
        return sorted(dt.date.fromisoformat(name.removeprefix("dt=")) for name in names)

    def latest_date(self, spark: SparkSession, path: str, as_of: dt.date | str | None = None) -> dt.date:
        """The newest partition, or the newest one up to `as_of`."""
        dates = [d for d in self.dates(spark, path) if as_of is None or d <= as_date(as_of)]
        if not dates:
            raise EmptySnapshotError(f"no partition below {path}" + (f" up to {as_of}" if as_of else ""))
        return dates[-1]


# -- landing area -------------------------------------------------------------------------


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that fills while the frame is written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _replace_partition(
    df: DataFrame, path: str, day: dt.date | str, fmt: str, label: str, audit: Audit | None = None
) -> int:
    """Replace exactly one date of a partitioned table; return the rows written.

    The rows are written aside and audited there. Only then does their folder take the place of the old
    one, which is moved away first and comes back if the move fails. An empty frame, a failed
    write or audit leaves the date as it was.
    """
    spark, day = df.sparkSession, as_date(day)
    restore_partitions(spark, path, day)
    aside = f"{path}/{STAGED}/{uuid.uuid4().hex}"
    counted, seen = _counted(df, f"{label} rows")
    try:
        counted.write.option("ignoreNullFields", "false").format(fmt).save(aside)
        rows = seen.get["rows"]
        if not rows:
            raise EmptySnapshotError(f"[{label}] 0 rows for dt={day}, nothing written")
        if audit:
            audit(spark.read.schema(df.schema).format(fmt).load(aside))
        _publish_partition(spark, aside, path, day)
    finally:
        _remove(spark, aside)
    return rows


def _publish_partition(spark: SparkSession, aside: str, path: str, day: dt.date) -> None:
    live, away = f"{path}/{date_folder(day)}", f"{path}/{REPLACED}/{date_folder(day)}"
    if path_exists(spark, live):
        _move(spark, live, away)
    try:
        _move(spark, aside, live)
    except Exception:
        restore_partitions(spark, path, day)
        raise
    _remove(spark, away)


def restore_partitions(spark: SparkSession, path: str, day: dt.date | None = None) -> list[str]:
    """Bring back dates that a failed replacement moved away and did not replace: one date, or all.

    A load does this for its own date first. Do not restore all while other loads of the table run.
    """
    restored = []
    for name in _folders(spark, f"{path}/{REPLACED}"):
        if day is not None and name != date_folder(day):
            continue
        away = f"{path}/{REPLACED}/{name}"
        if path_exists(spark, f"{path}/{name}"):
            _remove(spark, away)
        else:
            _move(spark, away, f"{path}/{name}")
            restored.append(name)
    return restored


def write_snapshot(lake: Lake, rows: DataFrame, source: str, day: dt.date | str) -> int:
    """Land one snapshot as JSON lines. NULL fields and non-ASCII text are kept."""
    return _replace_partition(rows, lake.landing(source), day, "json", source)


def write_snapshot_lines(lake: Lake, lines: DataFrame, source: str, day: dt.date | str) -> int:
    """Land one snapshot from JSON lines (one text column) as they are, with all their fields."""
    return _replace_partition(lines, lake.landing(source), day, "text", source)


def read_snapshot(
    spark: SparkSession, lake: Lake, source: str, day: dt.date | str | None = None, infer: bool = False
) -> DataFrame:
    """Landed JSON lines of one date (only that folder is read), or of all dates.

    `infer` leaves the types to Spark, at the price of an extra pass over the files.
    """
    reader = spark.read.option("basePath", lake.landing(source))
    if not infer:
        reader = reader.schema(with_partition(SNAPSHOTS[source].schema))
    return reader.json(lake.snapshot(source, day) if day is not None else lake.landing(source))


# -- raw tables ---------------------------------------------------------------------------


def load_snapshot(
    spark: SparkSession, lake: Lake, source: str, day: dt.date | str, audit: Audit | None = None
) -> int:
    """Load a landed snapshot into the raw table, replacing only that date.

    `audit` gets the rows as they will be read and raises if they must not replace the old ones.

    Fields beyond the known columns are kept as JSON text in `rest`. A line that is no
    JSON object, or whose value does not fit its column, fails the load as a whole.
    """
    schema = SNAPSHOTS[source].schema
    lines = spark.read.text(lake.snapshot(source, day)).where("trim(value) <> ''")
    known = schema.fieldNames()
    other = F.map_filter(F.from_json("value", "map<string,string>"), lambda k, _: ~k.isin(known))
    landed = lines.select(
        F.from_json("value", schema, {"mode": "FAILFAST"}).alias("row"),
        F.when(F.size(other) > 0, F.to_json(other)).alias("rest"),
    ).select("row.*", "rest")
    return _replace_partition(landed, lake.table(source, "raw"), day, "parquet", source, audit)


def load_sources(spark: SparkSession, lake: Lake, day: dt.date | str, source: str = "all") -> dict[str, int]:
    """Load one or all registered sources, side by side; rows per source, in registry order."""
    return run_together(
        spark, {s.name: partial(load_snapshot, spark, lake, s.name, day) for s in pick(source)}
    )


def read_raw(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A declared raw table by name, with its fixed schema."""
    if name == EVENTS:
        return read_events(spark, lake)
    schema = with_partition(SNAPSHOTS[name].schema)
    return spark.read.schema(schema).parquet(lake.table(name, "raw"))


def read_raw_date(spark: SparkSession, lake: Lake, name: str, day: dt.date | str | None = None) -> DataFrame:
    """One date of a raw table (default: the newest); lists one folder, opens one date."""
    path = lake.table(name, "raw")
    day = as_date(day) if day is not None else lake.latest_date(spark, path)
    schema = with_partition(SNAPSHOTS[name].schema)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/dt={day.isoformat()}")


def event_tables(lake: Lake) -> list[str]:
    return [lake.table(EVENTS, "raw"), lake.table(STREAMED, "raw")]


def event_dates(spark: SparkSession, lake: Lake) -> list[dt.date]:
    return sorted({day for path in event_tables(lake) for day in lake.dates(spark, path)})


def read_events(
    spark: SparkSession,
    lake: Lake,
    since: dt.date | str | None = None,
    dates: Collection[dt.date | None] | None = None,
) -> DataFrame:
    """Landed event messages, optionally from the partition `since` on or of some dates only.

    A streamed table is read through its commit log, so files of a batch that has not
    finished are not seen, and this can run at any time beside the stream. The log may
    still list dates that retention has deleted; they lie before the first folder and are
    pruned. Messages without a publication time are always included.
    """
    schema = with_partition(EVENT_MESSAGE)
    found = []
    for path in event_tables(lake):
        if not _folders(spark, path):
            continue
        wanted = [*lake.dates(spark, path)[:1], *([as_date(since)] if since is not None else [])]
        part = spark.read.schema(schema).parquet(path)
        if wanted:
            part = part.where(F.col("dt").isNull() | (F.col("dt") >= F.lit(max(wanted))))
        if dates is not None:
            part = part.where(in_dates([*dates, None]))
        found.append(part)
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def landed_files(events: DataFrame) -> dict[dt.date, str]:
    """Per publication date a digest of the names of the files that `events` reads."""
    names: dict[dt.date, list[str]] = {}
    for path in events.inputFiles():
        folder = re.search(r"/dt=(\d{4}-\d\d-\d\d)/", path)
        if folder:
            names.setdefault(as_date(folder[1]), []).append(path)
    return {day: hashlib.sha256("\n".join(sorted(n)).encode()).hexdigest() for day, n in names.items()}


def write_events(lake: Lake, messages: DataFrame) -> None:
    """Append event messages in batch form, by the UTC date of their publication."""
    (
        messages.withColumn("dt", F.to_date("publish_time"))
        .hint("rebalance", "dt")
        .write.mode("append")
        .partitionBy("dt")
        .parquet(lake.table(EVENTS, "raw"))
    )


# -- results ------------------------------------------------------------------------------


def write_table(df: DataFrame, lake: Lake, name: str, layer: str) -> DataFrame:
    """Rebuild a table in full and return it as read back from storage."""
    path = lake.table(name, layer)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_tables(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    tables: Mapping[str, DataFrame],
    audit: Callable[[Mapping[str, DataFrame]], None] | None = None,
    layouts: Mapping[str, tuple[str, str]] | None = None,
) -> dict[str, DataFrame]:
    """Write a new version of all tables, audit it, and let readers switch to it at once.

    A layout `(folder column, sort column)` puts the rows of each value of the first in a folder of its own,
    sorted by the second in small row groups: a reader of few values opens few files and skips most of them.
    Readers follow a note that names the version. Until it is written they see the last version as it
    was, also if a write or the audit fails. The last few versions stay for readers that have begun.
    """
    folder, version = lake.table("published", layer), uuid.uuid4().hex
    number = note_number(spark, folder)

    def written(name: str) -> DataFrame:
        path, table = lake.version(name, version, layer), tables[name]
        if name in (layouts or {}):
            folder, by = layouts[name]
            sorted_rows = table.repartitionByRange(folder, by).sortWithinPartitions(folder, by)
            sorted_rows.write.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(folder).parquet(path)
        else:
            table.write.parquet(path)
        return spark.read.schema(table.schema).parquet(path).select(table.columns)

    try:
        result = run_together(spark, {name: partial(written, name) for name in tables})
        if audit:
            audit(result)
        before = read_note(spark, folder) or {"versions": []}
        kept = [version, *before["versions"]][:KEPT_VERSIONS]
        schemas = {name: table.schema.json() for name, table in result.items()}
        write_note(spark, folder, {"versions": kept, "schemas": schemas}, after=number)
    except Exception:
        _remove(spark, lake.version("", version, layer).rstrip("/"))
        raise
    for old in before["versions"]:
        if old not in kept:
            _remove(spark, lake.version("", old, layer).rstrip("/"))
    return result


def published(spark: SparkSession, lake: Lake, layer: str) -> dict | None:
    """The note of the version that readers follow."""
    return read_note(spark, lake.table("published", layer))


def read_published(spark: SparkSession, lake: Lake, name: str, layer: str) -> DataFrame:
    """A table of the published version."""
    note = published(spark, lake, layer)
    if not note:
        raise EmptySnapshotError(f"nothing was published in {layer}")
    schema = StructType.fromJson(json.loads(note["schemas"][name]))
    return spark.read.schema(schema).parquet(lake.version(name, note["versions"][0], layer)).select(schema.fieldNames())


def write_report(
    df: DataFrame, lake: Lake, name: str, day: dt.date | str, single_file: bool = False, preview: int = 0
) -> DataFrame:
    """Write one dated report and return it as read back.

    The preview comes from the written rows, so the plan does not run a second time.
    """
    path = lake.report(name, day)
    (df.repartition(1) if single_file else df).write.mode("overwrite").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    if preview:
        written.show(preview, truncate=False)
    return written


# -- retention ----------------------------------------------------------------------------


def retention(partitions: DataFrame, as_of: dt.date | str, days: int = RETENTION_DAYS) -> DataFrame:
    """Mark the partitions of `(table_name, dt)` that have passed the retention time.

    The newest partition of a table never expires: readers select the newest one, and a
    table that is loaded rarely would otherwise turn empty.
    """
    newest = partitions.groupBy("table_name").agg(F.max("dt").alias("newest"))
    cutoff = F.date_sub(F.lit(as_date(as_of)), days)
    return (
        partitions.select("table_name", "dt")
        .distinct()
        .join(newest, "table_name")
        .select("table_name", "dt", ((F.col("dt") < cutoff) & (F.col("dt") < F.col("newest"))).alias("expired"))
    )


def expired_dates(
    spark: SparkSession, lake: Lake, path: str, as_of: dt.date | str, days: int = RETENTION_DAYS
) -> list[dt.date]:
    """Expired partition dates of one table, from its folder names."""
    dates = lake.dates(spark, path)
    cutoff = as_date(as_of) - dt.timedelta(days=days)
    return [d for d in dates[:-1] if d < cutoff]


def partition_files(
    spark: SparkSession, path: str, dates: Iterable[dt.date | None]
) -> dict[dt.date | None, frozenset[str]]:
    """Names of the data files of the given dates."""
    return {
        day: frozenset(status.getPath().getName() for status in list_folder(spark, f"{path}/{date_folder(day)}"))
        for day in dates
    }


def held_dates(spark: SparkSession, lake: Lake, path: str) -> set[dt.date | None]:
    """Partition dates of a table, None among them if it has rows without a date."""
    return {*lake.dates(spark, path), *([None] if NO_DATE in _folders(spark, path) else [])}


def replace_dates(df: DataFrame, path: str, dates: Collection[dt.date | None]) -> None:
    """Put the rows of `df` in place of those dates it has, and drop the given ones it has no rows of.

    `df` may be derived from the table itself; dates that are neither given nor in it stay. The
    overwrite leaves a date alone that has no rows any more: its files are still the old ones, and they
    go after the new rows are safe.
    """
    spark = df.sparkSession
    before = partition_files(spark, path, dates)
    (
        df.hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )
    after = partition_files(spark, path, dates)
    drop_partitions(spark, path, [d for d in dates if after[d] and after[d] == before[d]])


def drop_partitions(spark: SparkSession, path: str, dates: Iterable[dt.date | None]) -> None:
    """Delete the given date folders of a table (only on explicit request)."""
    for day in dates:
        _remove(spark, f"{path}/{date_folder(day)}")

