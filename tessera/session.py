"""Session helpers.

Library code never creates a session behind the caller's back; these helpers
are for scripts, tests and the bench.  Checkpoint locations are always read
from ``spark.checkpoint.dir``; a scratch directory is only chosen when the
setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera") -> SparkSession:
    master = master or os.environ.get("TESSERA_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("TESSERA_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only when it is unset and the master is local (tests) a fresh scratch folder is
    made; on a cluster without the setting this is an error, as executors would write to
    their own disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def at_once(spark: SparkSession, calls: Iterable[Callable], threads: int | None = None) -> list:
    """Results of independent driver calls, submitted together so that Spark fills its cores with their tasks: as many
    at a time as the cluster has cores (4 to 16), or ``threads``."""
    threads = threads or min(16, max(4, spark.sparkContext.defaultParallelism))
    with ThreadPoolExecutor(threads) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}"
