"""The daily run: land, load, clean, build marts, check, publish."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.operators.quality import enforce, quality_report
from rankmill.plans.analysis import regulated_origin
from rankmill.plans.checks import check_history
from rankmill.plans.history import (
    CLEAN_EVENTS,
    CLEAN_SCHEMA,
    apply_changes,
    changed_dates,
    clean_events,
    refresh_activity,
    refresh_events,
    refresh_per_day,
    remember_refresh,
)
from rankmill.plans.marts import (
    Weights,
    rank_products,
    scores_from_activity,
)
from rankmill.plans.staging import (
    stg_ingredient,
    stg_manufacturer,
    stg_products,
    stg_regulation,
)
from rankmill.session import run_together, use_utc
from rankmill.sources.lake import (
    EmptySnapshotError,
    Lake,
    as_date,
    event_dates,
    landed_files,
    list_folder,
    load_snapshot,
    publish_tables,
    read_events,
    read_published,
    read_raw_date,
    read_snapshot,
    write_report,
)
from rankmill.sources.notes import read_note, write_note
from rankmill.sources.pages import land_pages
from rankmill.sources.schemas import SNAPSHOTS, SOURCES

__all__ = ["changed_dates", "refresh_activity", "refresh_events", "run_daily", "staging_views"]

STAGING, MARTS = "staging", "marts"
RECOMMENDATIONS, PER_DAY, REPORT = "recommendations", "dashboard_events_daily", "quality_report"

_SNAPSHOT_MODELS = {
    "ingredient": stg_ingredient,
    "regulation": stg_regulation,
    "manufacturer": stg_manufacturer,
    "products": stg_products,
}


# The lookup asks for the first ranks of one segment.
LAYOUTS = {RECOMMENDATIONS: ("skin_type", "rank")}


class StageError(RuntimeError):
    """A stage of the run failed; the message names the stage and each source that failed in it."""


@dataclass(frozen=True)
class DailyRun:
    """What a run did: rows loaded per source, the models, the check report, stages it found done."""

    loaded: dict[str, int]
    models: dict[str, DataFrame]
    report: DataFrame
    skipped: tuple[str, ...] = ()

    @property
    def total_rows(self) -> int:
        return sum(self.loaded.values())


def regulated_origin_report(
    spark: SparkSession, lake: Lake, day: dt.date | str, preview: int = 0, single_file: bool = False
) -> DataFrame:
    """The origin report straight from the landed snapshots of one date, written per date.

    It needs no raw tables. `preview` prints the first rows of the written report.
    """
    ingredient = read_snapshot(spark, lake, "ingredient", day)
    regulation = read_snapshot(spark, lake, "regulation", day)
    report = regulated_origin(ingredient, regulation)
    return write_report(report, lake, "regulated_origin", day, single_file, preview)


def staging_views(spark: SparkSession, lake: Lake, as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """Snapshot models over the newest partition of each raw table, also as temp views.

    With `as_of` it is the newest one up to that date. The date comes from the folder
    names, so only that partition is opened.
    """
    views = {}
    for source, model in _SNAPSHOT_MODELS.items():
        day = lake.latest_date(spark, lake.table(source, "raw"), as_of)
        views[f"stg_{source}"] = model(read_raw_date(spark, lake, source, day), as_of=day)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views


def changed_since(spark: SparkSession, lake: Lake, landed: dict[dt.date, str]) -> dt.date | None:
    """The first publication date whose files differ from those of the last complete refresh.

    None asks for a rebuild, as there was no refresh yet. If nothing changed, it is the newest date.
    """
    dates = changed_dates(spark, lake, landed)
    return None if dates is None or not landed else min(dates & landed.keys(), default=max(landed))


# -- stages -------------------------------------------------------------------------------


class StageLedger:
    """Which stages of a day are done, and with what input; a stage whose input is the same is skipped."""

    def __init__(self, spark: SparkSession, lake: Lake, day: dt.date | str):
        self.spark, self.folder = spark, lake.run(day)
        self.done: dict[str, dict] = read_note(spark, self.folder) or {}
        self.skipped: list[str] = []

    def rows(self, stage: str, digest: str) -> int | None:
        """Rows of a stage that was done with this input, else None."""
        entry = self.done.get(stage)
        if entry and entry["input"] == digest:
            self.skipped.append(stage)
            return entry["rows"]
        return None

    def add(self, finished: Mapping[str, tuple[str, int]]) -> None:
        if finished:
            self.done |= {stage: {"input": digest, "rows": rows} for stage, (digest, rows) in finished.items()}
            write_note(self.spark, self.folder, self.done)


def _side_by_side(
    spark: SparkSession, ledger: StageLedger, stage: str, digests: Mapping[str, str], job: Callable[[str], int]
) -> dict[str, int]:
    """Run a stage for all sources that are not done; rows per source.

    Every source is tried. What succeeded is noted before the failed ones are raised by name.
    """
    rows = {name: ledger.rows(f"{stage} {name}", digest) for name, digest in digests.items()}

    def tried(name: str) -> int | Exception:
        try:
            return job(name)
        except Exception as failure:  # reported below, with its source
            return failure

    results = run_together(spark, {n: partial(tried, n) for n, done in rows.items() if done is None})
    ledger.add({f"{stage} {n}": (digests[n], r) for n, r in results.items() if not isinstance(r, Exception)})
    failed = {n: r for n, r in results.items() if isinstance(r, Exception)}
    if failed:
        told = "; ".join(f"{name}: {failure}" for name, failure in failed.items())
        raise StageError(f"{stage} failed for {told}") from next(iter(failed.values()))
    return {name: results.get(name, done) for name, done in rows.items()}


def _page_digests(pages: DataFrame, sources: Iterable[str]) -> dict[str, str]:
    """Per source a digest of its pages that does not depend on their order."""
    each = F.xxhash64("page_no", "payload")
    sums = pages.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(each).alias("x"), F.sum(each.cast("decimal(38,0)")).alias("s"))
    found = {r["source"]: f"{r['n']} {r['x']} {r['s']}" for r in sums.collect()}
    return {name: found.get(name, "no pages") for name in sources}


def _folder_digest(spark: SparkSession, path: str) -> str:
    files = sorted(
        f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}"
        for s in list_folder(spark, path)
        if not s.getPath().getName().startswith(("_", "."))
    )
    return hashlib.sha256("\n".join(files).encode()).hexdigest()


def land_day(spark: SparkSession, lake: Lake, pages: DataFrame, day: dt.date | str, partial_feeds: bool = False) -> dict[str, int]:
    """Land the pages of all master lists as the snapshots of a day; rows per source.

    A refused page, a short feed or a source without pages fails that source by name; the others
    are landed, and a rerun with the same pages does not land them again.
    """
    ledger = StageLedger(spark, lake, day)
    return _land(spark, lake, ledger, pages, day, partial_feeds)


def _land(spark, lake: Lake, ledger: StageLedger, pages: DataFrame, day, partial_feeds: bool) -> dict[str, int]:
    named = [name for name in SNAPSHOTS if name in SOURCES]
    return _side_by_side(
        spark, ledger, "land", _page_digests(pages, named), lambda name: land_pages(lake, pages, name, day, partial_feeds)
    )


def _load(spark: SparkSession, lake: Lake, ledger: StageLedger, day, catalog: bool) -> dict[str, int]:
    named = [*SOURCES, *(["products"] if catalog else [])]
    digests = {name: _folder_digest(spark, lake.snapshot(name, day)) for name in named}
    return _side_by_side(spark, ledger, "load", digests, lambda name: load_snapshot(spark, lake, name, day))


# -- marts --------------------------------------------------------------------------------


def loaded_rows(spark: SparkSession, lake: Lake, as_of: dt.date | str | None = None) -> dict[str, int]:
    """Rows of the snapshots the models take, as their loads counted them; sources without a count are left out."""
    rows = {}
    for source in _SNAPSHOT_MODELS:
        day = lake.latest_date(spark, lake.table(source, "raw"), as_of)
        done = (read_note(spark, lake.run(day)) or {}).get(f"load {source}")
        if done:
            rows[source] = done["rows"]
    return rows


def read_mart(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A mart as it was published last."""
    return read_published(spark, lake, name, MARTS)


def run_daily(
    spark: SparkSession,
    lake: Lake,
    day: dt.date | str,
    catalog: bool = False,
    events_since: dt.date | str | None = None,
    weights: Weights = Weights(),
    check: bool = True,
    as_of: dt.date | str | None = None,
    rebuild: bool = False,
    pages: DataFrame | None = None,
) -> DailyRun:
    """Land one day's pages, load them, bring the models up to date, check them, publish the marts.

    Without `pages` the landed snapshots of the day are taken. A stage that fails stops the later ones;
    a rerun skips what is done with the same input. The date is explicit, so the load of any day can
    be run again. The models take the newest lists that are loaded, which may be later than
    `day`; `as_of` takes the newest ones up to that date instead. The catalog has its own
    rhythm and is loaded on request.

    Of the events only publication dates whose files changed since the last run are read, unless
    `events_since` names a date to start from; `rebuild` starts over. Marts and report are written
    aside and published together once the checks hold; readers see the last version until then.
    """
    use_utc(spark)
    ledger = StageLedger(spark, lake, day)
    if pages is not None:
        _land(spark, lake, ledger, pages, day, False)
    loaded = _load(spark, lake, ledger, day, catalog)
    staging = staging_views(spark, lake, as_of)
    if staging["stg_products"].isEmpty():
        raise EmptySnapshotError("the product catalog is empty")
    # listed before it is read: files that land in between are read again by the next run
    landed = landed_files(read_events(spark, lake))
    changed = None if rebuild else changed_dates(spark, lake, landed)
    if events_since and not rebuild:
        changed = {d for d in event_dates(spark, lake) if d >= as_date(events_since)} | (changed or set())
    changes = apply_changes(spark, lake, changed)
    dates, happened = (None, None) if changed is None else (changes.published, changes.happened)
    derived = run_together(
        spark,
        {
            "activity": lambda: refresh_activity(spark, lake, dates=dates),
            "per_day": lambda: refresh_per_day(spark, lake, dates, happened),
            "checks": lambda: check_history(spark, lake, CLEAN_EVENTS, CLEAN_SCHEMA),
        },
    )
    remember_refresh(spark, lake, landed)

    scores = scores_from_activity(derived["activity"], weights)
    counted = loaded_rows(spark, lake, as_of)
    ranked = rank_products(scores, staging["stg_products"], staging["stg_regulation"], loaded=counted)
    report: list[DataFrame] = []

    def audit(marts: Mapping[str, DataFrame]) -> None:
        lines = quality_report({**staging, **marts}).unionAll(derived["checks"])
        report.append(spark.createDataFrame(lines.collect(), lines.schema))  # a line per check
        if check:
            enforce(report[0])

    marts = publish_tables(spark, lake, MARTS, {RECOMMENDATIONS: ranked, PER_DAY: derived["per_day"]}, audit, LAYOUTS)
    return DailyRun(
        loaded, {**staging, CLEAN_EVENTS: clean_events(spark, lake).drop("dt"), **marts}, report[0], tuple(ledger.skipped)
    )
