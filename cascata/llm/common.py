"""Shared folder tables, text helpers and bounded gathering for the corpus operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HELD_OUT_FOLDS = 5
#: Pattern of a word: everything but the six ASCII blanks. ``bytes.split()`` cuts at the same places.
BLANK = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once a session."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "cascata_llm.zip")
    with zipfile.ZipFile(path, "w") as out:
        out.write(os.path.join(package, "__init__.py"), "cascata/__init__.py")
        for name in sorted(os.listdir(os.path.dirname(os.path.abspath(__file__)))):
            if name.endswith(".py"):
                out.write(os.path.join(package, "llm", name), f"cascata/llm/{name}")
    context.addPyFile(path)
    context._llm_shipped = True


def spare(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def store(df: DataFrame, label: str = "part") -> DataFrame:
    """Write ``df`` to a new folder among the shared ones and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark's setting by which the shuffle files of a query go when it ends, not when the driver forgets them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession):
    """Shuffle files of the tables stored inside go as soon as each one is written."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def release(*frames: DataFrame) -> None:
    """Delete tables written by ``store`` that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text, null and empty alike."""
    filled = F.coalesce(text, F.lit(""))
    return [F.xxhash64(filled).alias("_h1"), F.xxhash64(F.lit("second"), filled).alias("_h2")]


def fold_of(doc_id: Column, folds: int = HELD_OUT_FOLDS) -> Column:
    """Fold of a document: crc32 of its id as text; a null id is in fold 0, so it is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0)).cast("int")


def bounded_labels(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of either class from the learning folds, drawn by a hash of the id.

    One label a document: of several the greatest. Rows with a null id or label are left out.
    """
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
        .where("_id is not null and _y in (0, 1)")
        .where(fold_of(F.col("_id")) != 0)
        .groupBy("_id")
        .agg(F.max("_y").alias("_y"))
    )
    drawn = [
        known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        for y in (0, 1)
    ]
    return drawn[0].unionByName(drawn[1])


def sum_arrays(df: DataFrame, column: str, kind: str = "double"):
    """Sum equal-length arrays, one a partition: at most 32 at a time on executors, then the few that are left.

    Three rounds, so 100,000 partitions leave four arrays for the driver. Returns a numpy vector, or None
    without rows; ``kind`` is the type of the entries.
    """
    import numpy as np
    import pandas as pd

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(frame["v"].to_list(), axis=0)
        return pd.DataFrame({"v": [total], "_g": [frame["_g"].iloc[0] // 32]})

    part = df.select(F.col(column).alias("v"), F.floor(F.spark_partition_id() / 32).cast("int").alias("_g"))
    for _ in range(3):
        part = part.groupBy("_g").applyInPandas(added, f"v array<{kind}>, _g int")
    rows = part.collect()
    return np.sum([np.array(r["v"]) for r in rows], axis=0) if rows else None
