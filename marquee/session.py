"""Session set-up and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def job_session(app_name: str) -> SparkSession:
    """Session for a submitted job; master and resources come from the submit command.

    Adaptive execution stays on: it picks broadcast joins from measured sizes and
    splits join partitions that one hot key has made too large.
    """
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names, else the one in use.

    Only a local session (one machine) may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="marquee-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def enable_checkpoints(spark: SparkSession) -> None:
    """Point the context at the shared folder unless it already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = shared_folder(spark)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; each call gives a different one."""
    return f"{shared_folder(spark)}/marquee/{label}-{uuid.uuid4().hex}"


# Seconds after which objects that Python has let go are taken as let go in the JVM too.
LET_GO_SECONDS = 10


def release_unused(spark: SparkSession) -> None:
    """Have shuffle files and blocks deleted that belong to no frame or model still in use.

    Spark deletes them once the driver's memory is collected, which a driver with room to spare may
    not do for half an hour. Spark's listeners remember the last query with all its plan refers to,
    so trivial ones take its place; objects that the first collection finds may hold others.
    Py4J's thread that tells the JVM what Python has let go sleeps for a second at a time, and what
    it has not told yet the JVM keeps, so the first collection waits for it.
    """
    told = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", ())
    end = time.monotonic() + LET_GO_SECONDS
    for first in (True, False):
        spark.range(1).collect()
        gc.collect()
        while first and told and time.monotonic() < end:
            time.sleep(0.05)
        spark.sparkContext._jvm.System.gc()
