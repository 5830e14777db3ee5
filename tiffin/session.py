"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot customer or restaurant is split across tasks in the lookup joins.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where the split costs a later join on the same key its ready-made partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Recording a stack trace for every column expression costs more than planning most of the queries here.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}

_local_folders: dict[str, str] = {}


def session(app: str = "tiffin", master: str | None = None, **conf: object) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can write to, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a machine-local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tiffin-")
    return _local_folders[app]


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the shuffle files of a query go when it ends; afterwards the session's own setting holds again.

    Otherwise they stay until the driver happens to collect its garbage, so a run of many queries keeps the shuffles of all of them on disk.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def forget_unused(spark: SparkSession) -> None:
    """Let Spark free what only its garbage collection finds, as the shuffles behind rows that were persisted and are no more."""
    gc.collect()
    spark._jvm.System.gc()
