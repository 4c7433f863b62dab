"""Write modes. Every table write is one Spark job; nothing passes through the driver.

Full replacements are versions (see ``versions``): a write that fails leaves the old rows in place.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType
from pyspark.sql.types import StringType

from cascata.sources import files, versions
from cascata.sources.scans import FILE_DATE


#: Column that names the load a row came with.
TOKEN = "load_token"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the shared folder in ``spark.checkpoint.dir``.

    Only a local session, whose executors see the driver's disk, may do without the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not base:
        import tempfile

        base = tempfile.mkdtemp(prefix="cascata-")
    return f"{base.rstrip('/')}/cascata-{uuid.uuid4().hex}"


_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """What ``stored`` writes inside is deleted at the end, when its readers are done."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            files.delete(spark, path)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to a scratch folder and read back, which ends its lineage in shared storage.

    The folder stays, unless a ``scratch`` block is open.
    """
    path = scratch_folder(df.sparkSession)
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _writer(df: DataFrame, partition_by: str | None):
    """Rows of a partition value go to few files; the rebalance splits hot values."""
    if partition_by is None:
        return df.write
    return df.hint("rebalance", partition_by).write.partitionBy(partition_by)


def overwrite(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    check: Callable[[DataFrame], Sequence[str]] | None = None,
) -> None:
    """Replace the table: the old rows stay readable until the new ones are written and checked."""
    versions.replace(df, path, lambda rows: _writer(rows, partition_by), check)


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Adds rows; a repeated run adds them again."""
    place = versions.folder(df.sparkSession, path)
    _writer(df, partition_by).mode("append").parquet(place)


def overwrite_partition(df: DataFrame, path: str, column: str, day: date) -> None:
    """Replace one partition and keep all others. A row of another day fails the job."""
    wrong = F.raise_error(F.concat(F.lit(f"row outside partition {day}: "), F.col(column)))
    checked = df.withColumn(
        column, F.when(F.col(column) == F.lit(day), F.col(column)).otherwise(wrong.cast("date"))
    )
    replace_partitions(checked, path, column)


def replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace the partitions that ``df`` has rows of, in the published version."""
    _writer(df, column).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(
        versions.folder(df.sparkSession, path)
    )


def replace_values(df: DataFrame, path: str, column: str, values: Sequence) -> None:
    """Replace the partitions of the given values; one that ``df`` has no rows of goes.

    Partitions are swapped one after another once all are written. A job that fails while it writes
    changes nothing.
    """
    spark = df.sparkSession
    with scratch(spark):
        rows = stored(df)
        written = {str(r[0]) for r in rows.select(column).distinct().collect()}
        if written:
            replace_partitions(rows, path, column)
    place = versions.folder(spark, path)
    for value in {str(v) for v in values} - written:
        name = "__HIVE_DEFAULT_PARTITION__" if value == "None" else value
        files.delete(spark, f"{place}/{column}={name}")


#: Rows of a bucket: some tens of MB for one task.
BUCKET_ROWS = 100_000


def buckets_for(rows: int, least: int = 1) -> int:
    """So many buckets that a bucket, which is one task's, stays of one size however many rows there are."""
    return max(least, -(-rows // BUCKET_ROWS))


def save_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 200
) -> None:
    """Store a catalog table by hash of its keys, sorted within each bucket.

    Joins, windows and groupings by the keys then need no shuffle. One file a bucket: rows are dealt to the
    buckets before they are written. The number of buckets should suit the cluster's tasks.
    """
    sorted_by = [*keys, *order]
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*sorted_by).option("path", path)
    writer.mode("overwrite").format("parquet").saveAsTable(name)


def append_once(df: DataFrame, path: str, token: str) -> None:
    """Append the rows of a load under its token; the same load again replaces its own rows.

    Repeated rows inside a load stay. The token is the table's partition column, so a load is replaced in
    one go and the rows of other loads are not read.
    """
    tagged = df.withColumn(TOKEN, F.lit(token))
    if versions.published(df.sparkSession, path) or files.exists(df.sparkSession, path):
        replace_partitions(tagged, path, TOKEN)
    else:
        overwrite(tagged, path, TOKEN)


def append_new(df: DataFrame, path: str, keys: list[str], partition_by: str | None = None) -> None:
    """Append one row for each key that the table does not hold yet: safe to run twice.

    Null keys are keys like others. Of new rows with one key, one is appended.
    """
    held = versions.read(df.sparkSession, path).select(*[F.col(k).alias(f"__held_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__held_{k}")) for k in keys])
    append(df.dropDuplicates(keys).join(held, same, "left_anti"), path, partition_by)


def file_date(name: str) -> str | None:
    found = re.search(FILE_DATE, name)
    return found.group(1) if found else None


def overwrite_snapshot(df: DataFrame, path: str, file_name: str, partition_by: str | None = None) -> bool:
    """Replace the table, but only for a dated file name. False means nothing was written."""
    if file_date(file_name) is None:
        return False
    overwrite(df, path, partition_by)
    return True


def landing_path(table: str, day: date) -> str:
    return f"{table}/{table}_{day:%Y-%m-%d}.csv"


def save_table(df: DataFrame, name: str, path: str) -> None:
    """Create or replace a catalog table whose rows lie under ``path``.

    A new version is written first; then the table's location is set to it. Only a table of other columns
    is declared anew. In either case the rows of the version before are not touched.
    """
    spark = df.sparkSession
    versions.replace(df, path)
    place = versions.folder(spark, path)
    if spark.catalog.tableExists(name):
        held = [(f.name, f.dataType) for f in spark.table(name).schema]
        if held == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, place, "parquet", df.schema)


NUMBERS = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType)


def export_grid(df: DataFrame) -> DataFrame:
    """Cells for a spreadsheet: nulls empty, numbers and text kept, other types as text."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if not isinstance(f.dataType, (*NUMBERS, StringType)):
            c = c.cast("string")
        empty = F.coalesce(c.cast("string"), F.lit(""))
        cells.append(empty.alias(f.name))
    return df.select(*cells)


def export_csv(df: DataFrame, path: str) -> bool:
    """Header and rows as CSV; an empty table writes nothing and gives False.

    ``df`` should be a stored table, as it is read for its first row and then for all.
    """
    if df.isEmpty():
        return False
    export_grid(df).write.mode("overwrite").csv(
        path,
        header=True,
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return True
