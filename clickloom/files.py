"""Folder listings through the cluster's own file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """``(file system, path object)`` for a path of any supported scheme."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def numbered_folders(spark: SparkSession, path: str, key: str) -> dict[int, str]:
    """Sub-folders ``key=N`` by N."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return {}
    found = {}
    for status in fs.listStatus(target):
        name = status.getPath().getName()
        if name.startswith(f"{key}="):
            found[int(name.split("=", 1)[1])] = status.getPath().toString()
    return found


def delete(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, target = file_system(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0
