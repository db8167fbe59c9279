"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings a cluster deployment should start with. Partition counts are an upper bound that
# adaptive execution coalesces; skewed join partitions are split at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Return a session with :data:`SETTINGS`; keyword settings override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one on a local master.

    On a cluster a folder of one machine would lose data, so there the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder and not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="reelstat-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Drops the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """For queries that write a table which holds all that is needed of their shuffles."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def saved(frame: DataFrame) -> DataFrame:
    """Compute a frame once and keep it in the shared folder, where a lost executor cannot hurt it."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def broadcast_if_small(kept: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast of a saved frame when it was counted to hold at most ``max_rows``.

    Beyond that the frame is returned without a hint and the join shuffles.
    """
    return F.broadcast(kept) if kept.count() <= max_rows else kept
