"""Session defaults and the shared folder that stages hand tables over in."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "almanack", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.driver.memory", os.environ.get("ALMANACK_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a temporary folder; on a
    cluster a machine-local one would lose data with the machine.
    """
    context = spark.sparkContext
    configured = context.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="almanack-")
    return _LOCAL_FOLDERS[context.applicationId]


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/almanack/{app}/{purpose}-{uuid.uuid4().hex[:12]}"


def run_together(jobs: Sequence[Callable[[], Any]], at_once: int = 4) -> list:
    """Submit independent Spark jobs at once, so that small ones do not wait for
    each other; results in order, the first failure is raised."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return [future.result() for future in [pool.submit(job) for job in jobs]]


def hand_over(df: DataFrame, purpose: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: computed once,
    lineage cut, size known to the optimizer, safe when executors are lost."""
    spark = df.sparkSession
    path = run_folder(spark, purpose)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_handed_over(spark: SparkSession) -> None:
    """Remove all tables that this application has handed over. Frames that still read
    them, and results that are not written yet, are lost; so call it when a run's results
    are where they belong."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/almanack/{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
