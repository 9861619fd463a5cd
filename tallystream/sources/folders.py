"""Folders of the cluster's file system, listed and removed by the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, in order; nothing where there is none."""
    path, system = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def exists(spark: SparkSession, file: str) -> bool:
    path, system = _path(spark, file)
    return system.exists(path)


def remove(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.delete(path, True)
