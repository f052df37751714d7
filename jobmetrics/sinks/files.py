"""Folders of any file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()), name


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with what is in it; nothing happens if it is not there."""
    system, name = _file_system(spark, path)
    system.delete(name, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, empty if it is not there."""
    system, name = _file_system(spark, path)
    if not system.exists(name):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(name))


def bytes_in(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder, 0 if it is not there."""
    system, name = _file_system(spark, path)
    return system.getContentSummary(name).getLength() if system.exists(name) else 0
