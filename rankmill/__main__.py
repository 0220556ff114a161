"""Command line: `python -m rankmill <job> --root <lake> ...`."""

from __future__ import annotations

import argparse

from rankmill.plans import daily, serving
from rankmill.session import build_session
from rankmill.sources import lake as lakes
from rankmill.sources.schemas import SNAPSHOTS


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="rankmill", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, dated: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="root folder of the lake")
        if dated:
            sub.add_argument("--date", required=True, help="snapshot date, YYYY-MM-DD")
        return sub

    land = job("land", "land the pages of the master lists as the snapshots of a day")
    land.add_argument("pages", help="Parquet folder of (source, page_no, payload)")
    load = job("load", "load landed snapshots into the raw tables")
    load.add_argument("sources", nargs="*", metavar="source", help=f"of {', '.join(SNAPSHOTS)}; none means all master lists")
    run = job("daily", "land if pages are given, load, clean, build the marts, check, publish")
    run.add_argument("--pages", help="Parquet folder of (source, page_no, payload) to land first")
    run.add_argument("--catalog", action="store_true", help="also load the product catalog")
    run.add_argument("--events-since", help="refresh the cleaned events from this date on (default: what changed)")
    run.add_argument("--rebuild", action="store_true", help="clean all events again")
    run.add_argument("--as-of", help="use the lists of this date or the newest before it")
    origin = job("origin-report", "regulated ingredients per origin, from the landed files")
    origin.add_argument("--single-file", action="store_true")
    top = job("recommend", "best products of a segment", dated=False)
    top.add_argument("segment")
    top.add_argument("--limit", type=int, default=serving.DEFAULT_LIMIT)
    old = job("retention", "list expired partitions; delete them only with --delete")
    old.add_argument("--days", type=int, default=lakes.RETENTION_DAYS)
    old.add_argument("--delete", action="store_true")
    return parser


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    if unknown := set(getattr(args, "sources", ())) - set(SNAPSHOTS):
        parser.error(f"unknown source: {', '.join(sorted(unknown))}")
    spark, lake = build_session(), lakes.Lake(args.root.rstrip("/"))
    if args.job == "land":
        for name, rows in daily.land_day(spark, lake, spark.read.parquet(args.pages), args.date).items():
            print(f"{lake.snapshot(name, args.date)}: {rows} rows")
    elif args.job == "load":
        loaded = {}
        for source in args.sources or ["all"]:
            loaded |= lakes.load_sources(spark, lake, args.date, source)
        for name, rows in loaded.items():
            print(f"{lakes.partition_address(name, args.date)}: {rows} rows")
        print(f"total: {sum(loaded.values())} rows")
    elif args.job == "daily":
        run = daily.run_daily(
            spark, lake, args.date, args.catalog, args.events_since, as_of=args.as_of, rebuild=args.rebuild,
            pages=spark.read.parquet(args.pages) if args.pages else None,
        )
        print(f"loaded {run.total_rows} rows, all checks passed")
    elif args.job == "origin-report":
        daily.regulated_origin_report(spark, lake, args.date, preview=20, single_file=args.single_file)
    elif args.job == "recommend":
        mart = daily.read_mart(spark, lake, daily.RECOMMENDATIONS)
        for row in serving.lookup(mart, args.segment, args.limit):
            print(row["rank"], row.product_id, row.product_name, row.score, sep="\t")
    elif args.job == "retention":
        paths = [lake.landing(s) for s in SNAPSHOTS]
        paths += [lake.table(s, "raw") for s in SNAPSHOTS] + lakes.event_tables(lake)
        for path in paths:
            expired = lakes.expired_dates(spark, lake, path, args.date, args.days)
            for day in expired:
                print(f"{path}/dt={day.isoformat()}")
            if args.delete:
                lakes.drop_partitions(spark, path, expired)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
