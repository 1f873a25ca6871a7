"""Spark session helpers.

A cluster deployment gets its session from ``spark-submit``; nothing here
hard-codes a master except :func:`local_session`, which exists for tests and the
benchmark.  :func:`checkpoint_dir` reads ``spark.checkpoint.dir`` from the session
(the shared folder the cluster names); where it is absent, a job keeps its intermediate
tables beside its output.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on; a cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "stationlens", extra: dict | None = None) -> SparkSession:
    """Session for tests and the local benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # One JVM: list many input folders with a few tasks, not one per folder.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(shuffle_partitions))
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _own_folder() -> str:
    """A temporary folder of this process, for local sessions."""
    folder = tempfile.mkdtemp(prefix="stationlens-ckpt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def checkpoint_dir(spark: SparkSession, near: str | None = None) -> str:
    """The folder for intermediate tables, which driver and executors share.

    ``spark.checkpoint.dir`` names it; where that is unset, a folder beside ``near`` (a
    job's output path) is used, as the cluster can reach that.  Without either only a local
    session gets a temporary folder of its own (tests).
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and near:
        folder = f"{near.rstrip('/')}-intermediate"
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = _own_folder()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")
