"""Times the headline queries and prints one JSON line.

Each query is built and run to the end (its rows go to Spark's `noop` sink) twice. `queries`
holds the second, warm run; `cold` the first one, which includes code generation.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from rankmill.session import build_session
from workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "recommendations",
    "product_risk",
    "skin_product_scores",
    "stg_events",
    "stg_ingredient",
    "events_daily",
    "regulated_origin",
    "rank_in_segment",
    "quality_report",
    "delivery_reconcile",
    "incremental_events",
    "daily_run",
    "api_pages_unwrap",
    "api_page_completeness",
)


def timed(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__sql__shuffle__partitions=CPUS,
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="rankmill-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: timed(spark, name) for name in HEADLINES}
    warm = {name: timed(spark, name) for name in HEADLINES}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
