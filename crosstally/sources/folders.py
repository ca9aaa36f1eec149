"""Folders of the file system that a path belongs to, as Spark's own readers and writers see them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    system, there = _at(spark, path)
    return system.exists(there)


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it isn't there."""
    system, there = _at(spark, path)
    if not system.exists(there):
        return []
    return [status.getPath().getName() for status in system.listStatus(there)]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    system, there = _at(spark, path)
    system.delete(there, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name, which must not be taken. One step on HDFS and on local disks."""
    system, there = _at(spark, path)
    _, target = _at(spark, to)
    if system.exists(target):
        raise FileExistsError(to)
    if not system.rename(there, target):
        raise OSError(f"{path} can't be renamed to {to}")
