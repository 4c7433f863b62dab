"""Scans. Filters on a partition column reach the file listing as PartitionFilters."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cascata.functions import dates as D
from cascata.functions import text as T
from cascata.sources import files, versions

FILE_DATE = r"(\d{4}-\d{2}-\d{2})\.csv$"  # fixed value: dated file name


def full_scan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All rows of a stored table, as last published."""
    return versions.read(spark, path, schema)


def partition_days(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column that a table's folders are named by, sorted; no file is opened."""
    place = versions.folder(spark, path)
    names = files.children(spark, place, folders_only=True)
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return [v for v in values if v != "__HIVE_DEFAULT_PARTITION__"]


def newest_partition(spark: SparkSession, path: str, column: str = "dt") -> date | None:
    """The newest day of a table that is partitioned by day, from its folder names."""
    days = partition_days(spark, path, column)
    return date.fromisoformat(days[-1]) if days else None


def newest_day_folder(spark: SparkSession, path: str) -> tuple[int, int, int] | None:
    """The newest year, month and day of a table partitioned by these three, from its folder names."""

    def numbers(place, name):
        found = files.children(spark, place, folders_only=True)
        return sorted((int(n.split("=")[1]) for n in found if n.startswith(f"{name}=")), reverse=True)

    place = versions.folder(spark, path)
    # A folder may be empty, so older ones are tried until a day is found.
    for year in numbers(place, "year"):
        for month in numbers(f"{place}/year={year}", "month"):
            for day in numbers(f"{place}/year={year}/month={month}", "day"):
                return year, month, day
    return None


def snapshot(df: DataFrame, day: date | None = None, column: str = "dt") -> DataFrame:
    """Rows of a known snapshot day, a plain partition filter; without one, those of the greatest day."""
    return latest_snapshot(df, column) if day is None else partition_day(df, column, day)


def one_snapshot(df: DataFrame, day: date | None = None, column: str = "dt") -> DataFrame:
    """Rows of a known snapshot day; without one, all rows."""
    return df if day is None else partition_day(df, column, day)


def custom_scan(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A query over named frames, written as ``{name}`` in the text."""
    return spark.sql(sql, **tables)


def partition_day(df: DataFrame, column: str, day: date) -> DataFrame:
    return df.where(F.col(column) == F.lit(day))


def previous_day(df: DataFrame, column: str, as_of: date) -> DataFrame:
    return df.where(F.col(column) == F.date_sub(F.lit(as_of), 1))


def partition_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def date_range(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Half-open range: start included, end not."""
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def month_bounds(month: str) -> tuple[date, date]:
    """'YYYY-MM' to the first day of that month and of the next one."""
    year, number = int(month[:4]), int(month[5:7])
    return date(year, number, 1), date(year + number // 12, number % 12 + 1, 1)


def month_range(df: DataFrame, column: str, month: str) -> DataFrame:
    return date_range(df, column, *month_bounds(month))


def latest_snapshot(df: DataFrame, column: str = "dt", strict: bool = False) -> DataFrame:
    """Rows of the greatest snapshot date. ``strict`` fails at run time when there is none."""
    newest = F.max(column)
    if strict:
        newest = F.coalesce(newest, F.raise_error(F.lit(f"no snapshot: max({column}) is null")))
    return df.where(F.col(column) == df.select(newest).scalar())


def day_number() -> Column:
    """year/month/day partition columns as one number."""
    return F.col("year") * 10000 + F.col("month") * 100 + F.col("day")


def newest_day_number(df: DataFrame, as_of: date) -> DataFrame:
    return df.where(F.col("year") >= as_of.year).select(F.max(day_number()).alias("max_dt"))


def split_day_number(c: Column) -> tuple[Column, Column, Column]:
    """Year, month and day of a day number, with whole divisions."""
    whole = lambda a, b: F.floor(a / F.lit(b)).cast("int")
    return whole(c, 10000), whole(c % 10000, 100), (c % 100).cast("int")


def at_day_number(df: DataFrame, newest: DataFrame) -> DataFrame:
    """Rows of one year/month/day partition given as a one-row, one-column frame."""
    return df.where(day_number() == newest.scalar())


def at_day(df: DataFrame, day: tuple[int, int, int]) -> DataFrame:
    """Rows of one known year/month/day partition; three plain partition filters."""
    year, month, number = day
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == number))


def csv_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header row, declared types; a malformed row fails instead of shifting columns."""
    return spark.read.schema(schema).csv(path, header=True, mode="FAILFAST", enforceSchema=False)


def date_of_file(path: Column) -> Column:
    """Date at the end of a ``*_YYYY-MM-DD.csv`` name, null if there is none."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, FILE_DATE, 1), F.lit("")), "yyyy-MM-dd")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, text``: every line of text files with its number in its file, from 1.

    Files may be split: a block's lines are numbered by the order in which they are read, and the lines of
    the blocks before are added, which takes one row a block.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__at"), F.col("value").alias("text"),
    )
    blocks = lines.groupBy("file", "__start").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    number = F.col("__before") + F.col("__at") - F.col("__first") + 1
    return lines.join(blocks, ["file", "__start"]).select("file", number.alias("line"), "text")


def csv_at(
    spark: SparkSession, path: str, columns: Sequence[str], header_line: int = 1, sep: str = ","
) -> DataFrame:
    """The named columns, as text, of CSV files whose header stands on a given line.

    Lines above it are titles and left out by their place, whatever they hold. Files may have their columns
    in different orders; a column that a file's header lacks is null. Cells may not hold line breaks; blank
    lines are no rows.
    """
    lines = numbered_lines(spark, path).where(F.col("line") >= header_line)
    cells = lambda text: F.transform(F.split(text, _separators(sep)), _unquoted)
    header = lines.where(F.col("line") == header_line).select(
        "file", F.transform(cells(F.col("text")), lambda c: F.lower(F.trim(c))).alias("__names")
    )
    data = lines.where((F.col("line") > header_line) & (F.trim("text") != ""))
    # One row a file goes to the lines; dealt by file, the lines of a file would be one task's.
    rows = data.join(F.broadcast(header), "file").withColumn("__cells", cells(F.col("text")))

    def cell(name):
        place = F.array_position("__names", F.lit(name.strip().lower())).cast("int")
        return F.when(place > 0, F.get("__cells", place - 1)).alias(name)

    return rows.select(*[cell(c) for c in columns])


def _separators(sep: str) -> str:
    """Separators outside quotes: an even number of quotes follows."""
    return f'{re.escape(sep)}(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _unquoted(cell: Column) -> Column:
    bare = F.regexp_replace(F.regexp_extract(cell, '^\\s*"(.*)"\\s*$', 1), '""', '"')
    return F.when(cell.rlike('^\\s*".*"\\s*$'), bare).otherwise(cell)


def types_by_day(spark: SparkSession, path: str, column: str = "dt") -> DataFrame:
    """``day, column, type`` of the columns stored in each daily partition, read from file footers.

    A day whose files disagree has the type ``mixed`` for all columns that differ among them. One footer
    read a day finds the types; Spark reads all footers of a day, in tasks, to tell whether they agree.
    """
    place, rows = versions.folder(spark, path), []
    for day in partition_days(spark, path, column):
        reader = spark.read.option("mergeSchema", "true")
        folder = f"{place}/{column}={day}"
        try:
            found = {f.name: f.dataType.simpleString() for f in reader.parquet(folder).schema}
        except AnalysisException:
            found = {}
        except Exception as e:  # files of one day that cannot be read with one schema
            if "merg" not in str(e).lower():
                raise
            found = {f.name: "mixed" for f in spark.read.parquet(folder).schema}
        rows += [(date.fromisoformat(day), name, kind) for name, kind in found.items()]
    return spark.createDataFrame(rows, "day date, column string, type string")


def type_turns(types: DataFrame) -> DataFrame:
    """``column, day, before, after``: the days on which a column's stored type changed, came or went."""
    names = sorted(r[0] for r in types.select("column").distinct().collect())
    if not names:
        return types.select("column", "day", F.col("type").alias("before"), F.col("type").alias("after"))
    # Columns times days, both as few as a table's partitions and columns.
    every = F.explode(F.array(*[F.lit(n) for n in names])).alias("column")
    known = types.select("day").distinct().select("day", every).join(types, ["day", "column"], "left")
    by_column = Window.partitionBy("column").orderBy("day")
    turned = known.withColumns({"before": F.lag("type").over(by_column), "__k": F.row_number().over(by_column)})
    changed = (F.col("__k") > 1) & ~F.col("before").eqNullSafe(F.col("type"))
    return turned.where(changed).select("column", "day", "before", F.col("type").alias("after"))


def locale_csv(
    spark: SparkSession,
    path: str,
    columns: list[str],
    day: str,
    numbers: list[str],
    titles: Sequence[str] = (),
) -> DataFrame:
    """Exported CSV with comma decimals and title lines above the data.

    Title lines are declared, not guessed: lines with nothing in them, lines that repeat the column
    names, and lines whose first cell is one of ``titles`` and that hold nothing else. All others are
    data and stay; an unreadable date becomes null, so ``day IS NULL`` counts them. The rule looks at
    lines alone, so the files can be split.
    """
    schema = StructType([StructField(c, StringType()) for c in columns])
    raw = spark.read.schema(schema).csv(path, header=False, mode="PERMISSIVE")
    cells = F.array(*[F.coalesce(F.trim(F.lower(F.col(c))), F.lit("")) for c in columns])
    others = F.array_distinct(F.slice(cells, 2, len(columns)))
    alone = (F.size(F.array_remove(others, "")) == 0) & cells[0].isin("", *[t.strip().lower() for t in titles])
    header = cells == F.array(*[F.lit(c.strip().lower()) for c in columns])
    data = raw.withColumn("__title", alone | header).where(~F.col("__title"))
    parsed = data.withColumns(
        {day: D.read_date(F.col(day)), **{n: T.locale_number(F.col(n)) for n in numbers}}
    )
    return parsed.drop("__title")
