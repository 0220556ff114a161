"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

UTC_KEY = "spark.sql.session.timeZone"
CHECKPOINT_KEY = "spark.checkpoint.dir"

# Sizes are left to AQE: it coalesces small shuffle partitions, splits skewed join and
# rebalance partitions, and turns a join into a broadcast only after measuring the side.
# Aggregations and windows are never split at run time, so their partitions have to be small
# enough to begin with: see `shuffle_partitions`.
LEAST_PARTITIONS = 200
PARTITION_BYTES = 128 * 2**20

DEFAULTS = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    UTC_KEY: "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions of a shuffle that moves the whole input; AQE merges those that stay small."""
    return max(LEAST_PARTITIONS, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app: str = "rankmill", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the models rely on; keyword names use `__` for dots.

    `input_bytes`, the size of the largest table, sets the number of shuffle partitions.
    """
    if input_bytes is not None:
        conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes)), **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event dates are UTC dates, so pin the session time zone."""
    if spark.conf.get(UTC_KEY, None) != "UTC":
        spark.conf.set(UTC_KEY, "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, as `spark.checkpoint.dir` names it.

    A temporary folder stands in only on a local master, where every task sees it.
    """
    context = spark.sparkContext
    configured = context.getConf().get(CHECKPOINT_KEY, None) or spark.conf.get(CHECKPOINT_KEY, None)
    if configured is None and context.getCheckpointDir():
        configured = context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="rankmill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, for tables a single run writes and reads back."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def run_together(spark: SparkSession, jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Submit independent Spark jobs at once, so that small ones share the executors.

    All are waited for; the first failure, in the given order, is raised.
    """
    with ThreadPoolExecutor(max_workers=max(len(jobs), 1)) as pool:
        submitted = inheritable_thread_target(spark)
        running = {name: pool.submit(submitted(job)) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}
