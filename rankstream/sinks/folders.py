"""Folder listing through Hadoop's file-system API, so that any shared store works."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folder's direct children; empty if there is no such folder."""
    fs, target = _filesystem(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since the file or folder was last written."""
    fs, target = _filesystem(spark, path)
    return (time.time() * 1000 - fs.getFileStatus(target).getModificationTime()) / 3_600_000


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below the folder."""
    fs, target = _filesystem(spark, path)
    return fs.getContentSummary(target).getLength()


def drop(spark: SparkSession, path: str) -> None:
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)
