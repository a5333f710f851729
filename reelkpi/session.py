"""Session settings and the shared storage folder.

The library never creates a session behind the caller's back: every public
function takes a DataFrame or a SparkSession. `local_session` is only for
tests, benchmarks and notebooks on one machine.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the reports rely on at any scale: runtime re-planning (broadcast
# conversion from measured sizes, partition coalescing, skew-join splitting).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def local_session(
    app: str = "reelkpi",
    master: str | None = None,
    shuffle_partitions: int = 8,
    checkpoint_dir: str | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    master = master or os.environ.get("REELKPI_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("REELKPI_DRIVER_MEMORY", "16g"))
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder; set `fallback` only if none is configured."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def session_key(spark: SparkSession) -> str:
    """Identity of a live session (a new or restarted session never reuses it)."""
    return spark._jsparkSession.sessionUUID()


def shared_root(spark: SparkSession) -> str:
    """Folder for tables this library writes, below the cluster's checkpoint folder.

    Without one, a session on a single machine (`local[...]`) writes below its
    SQL warehouse; on a cluster that could be each executor's own disk, so it
    is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/") + "/reelkpi"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below `shared_root` (one per write)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def broadcasts_on(spark: SparkSession) -> bool:
    """Whether the session allows automatic broadcasts (their threshold is not negative)."""
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


#: Rows that a task sorts or groups at a time, where the number of tasks is ours to say.
ROWS_PER_TASK = 250_000


@contextmanager
def enough_shuffle_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """Queries that run inside deal their rows to at least rows / ROWS_PER_TASK
    tasks, so that what a task sorts does not grow with the input and stays in
    memory. A larger setting of the session holds."""
    key = "spark.sql.shuffle.partitions"
    before, usual = spark.conf.get(key, None), int(spark.conf.get(key))
    spark.conf.set(key, str(max(usual, -(-rows // ROWS_PER_TASK))))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
