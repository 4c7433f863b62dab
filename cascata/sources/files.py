"""Folders of the cluster's file systems, by Hadoop's own client: names only, no file is opened."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str, folders_only: bool = False) -> list[str]:
    """Names right below a folder, sorted; none if there is no such folder."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    found = system.listStatus(place)
    return sorted(s.getPath().getName() for s in found if s.isDirectory() or not folders_only)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, made at once or not at all; one of that name is an error."""
    system, place = _place(spark, path)
    system.mkdirs(place.getParent())
    system.create(place, False).close()


def delete(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)
