"""Session settings the reports are planned for, and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

#: Runtime settings. None of them changes a result; they keep one hot key from holding up a job.
SETTINGS = {
    # Plans again between stages, with measured sizes: a side that turns out small is broadcast.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a join partition that is far larger than the others, also where the split costs the
    # next aggregation its partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = 8, memory: str = "8g", name: str = "crosstally", **options: str
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder, since there the driver and the
    executors are one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_folder()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there is removed when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="crosstally-")
