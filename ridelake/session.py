"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ridelake import paths

# AQE settings the plans in this library rely on: partition counts are chosen
# from measured shuffle sizes, skewed join partitions are split, and output
# partitions are rebalanced. The initial count only has to be large enough.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str = "ridelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in ADAPTIVE.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}
# What ``materialise`` has written, in order.
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """This application's own directory below ``spark.checkpoint.dir``.

    Every executor must reach it, so on a cluster the setting is required. Only
    a local session may fall back to a temporary directory.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to storage every executor can reach")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="ridelake-")
        root = _local_folders[app]
    return os.path.join(root, f"ridelake-{app}")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage durably (the files outlive any executor) and, unlike an RDD
    checkpoint, keeps column pruning and file-size statistics for the planner.
    """
    path = fresh_path(df.sparkSession, label)
    _written.append(path)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what ``materialise`` stores inside this scope when it ends.

    For jobs whose results are written elsewhere. Relations returned from the
    scope must not read its stored tables, and scopes of one application must
    not overlap in time, unless one lies inside the other.
    """
    start = len(_written)
    try:
        yield
    finally:
        for path in _written[start:]:
            paths.remove(spark, path)
        del _written[start:]


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list[object]:
    """Submit independent Spark jobs at the same time and wait for all of them.

    Short jobs on small results leave most of a cluster idle; run one after the
    other they add up to pure latency.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [r.result() for r in running]
