"""Tables that are replaced without being destroyed.

A replacement is written to a folder of its own, ``<table>/_versions/<name>``, may be checked there, and is
published by one empty marker file ``<table>/_published/<name>``. The marker with the greatest name tells which
version readers see. So a job that fails, a result that a check refuses, or a driver that dies leaves the
old rows readable, and no reader meets a half table. Names start with a number that grows, so order is
that of publishing; a table has one writer at a time. The version before stays until the next one is
published, for readers that have opened it.

Rows are appended to, and single partitions replaced in, the published version. A folder without markers is a
plain table, which stays readable until its first replacement is published.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cascata.sources import files

VERSIONS, PUBLISHED = "_versions", "_published"


class Refused(Exception):
    """A check turned a written version down; ``failures`` says why."""

    def __init__(self, path: str, failures: Sequence[str]):
        super().__init__(f"{path}: " + "; ".join(failures))
        self.failures = list(failures)


def published(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions that are still there, oldest first."""
    return files.children(spark, f"{path.rstrip('/')}/{PUBLISHED}")


def folder(spark: SparkSession, path: str) -> str:
    """Where the rows that readers see lie: the newest published version, or a plain table's own folder."""
    path = path.rstrip("/")
    names = published(spark, path)
    return f"{path}/{VERSIONS}/{names[-1]}" if names else path


def read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows published when this is called."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder(spark, path))


def write(df: DataFrame, path: str, writer: Callable[[DataFrame], object] | None = None) -> str:
    """Write a version that no reader sees yet; gives its name."""
    spark, path = df.sparkSession, path.rstrip("/")
    names = published(spark, path)
    number = int(names[-1].split("-")[0]) + 1 if names else 1
    name = f"{number:010d}-{uuid.uuid4().hex}"
    (writer(df) if writer else df.write).parquet(f"{path}/{VERSIONS}/{name}")
    return name


def publish(spark: SparkSession, path: str, name: str, keep: int = 1) -> None:
    """Show a version to readers, then remove what no reader needs: all but it and ``keep`` before it."""
    path = path.rstrip("/")
    files.mark(spark, f"{path}/{PUBLISHED}/{name}")
    names = published(spark, path)
    held = set(names[-1 - keep :])
    for old in names:
        if old not in held:
            files.delete(spark, f"{path}/{PUBLISHED}/{old}")
    for old in files.children(spark, f"{path}/{VERSIONS}"):
        if old not in held:
            files.delete(spark, f"{path}/{VERSIONS}/{old}")
    for plain in files.children(spark, path):
        if plain not in (VERSIONS, PUBLISHED):
            files.delete(spark, f"{path}/{plain}")


def discard(spark: SparkSession, path: str, name: str) -> None:
    files.delete(spark, f"{path.rstrip('/')}/{VERSIONS}/{name}")


def replace(
    df: DataFrame,
    path: str,
    writer: Callable[[DataFrame], object] | None = None,
    check: Callable[[DataFrame], Sequence[str]] | None = None,
) -> None:
    """Write, check what was written, publish. ``check`` gives what is wrong; anything raises ``Refused``."""
    spark = df.sparkSession
    name = write(df, path, writer)
    if check is not None:
        stored = spark.read.schema(df.schema).parquet(f"{path.rstrip('/')}/{VERSIONS}/{name}")
        failures = list(check(stored))
        if failures:
            discard(spark, path, name)
            raise Refused(path, failures)
    publish(spark, path, name)
