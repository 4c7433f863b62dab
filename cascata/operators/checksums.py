"""Compare two large tables by checksums first, and open only what differs.

A tree has, for each bucket of key hashes, the number of rows and, for each column, the sum of the hashes of
(key, value). Sums do not depend on order and count repeated rows. Trees are small, can be stored beside
their tables and roll up: bucket b of n is part of bucket b // 2 of n / 2. Rows are read only of buckets whose
checksums differ, and of those only the columns that do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
ROWS = "(rows)"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The same for equal keys of one type; null keys are keys like others."""
    return F.pmod(F.xxhash64(F.lit(len(keys)), *[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]), F.lit(buckets)).cast("int")


def _shown(column: str) -> Column:
    return F.col(column).cast("string")


def tree(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` and a checksum a column; at most ``buckets`` rows, one partial row a task and bucket."""
    key = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]

    def checksum(c):
        return F.sum(F.xxhash64(*key, _shown(c).isNull(), _shown(c)).cast("decimal(20,0)")).alias(f"sum_{c}")

    # The keys themselves have a checksum, as two rows may differ in nothing else.
    whole = F.sum(F.xxhash64(F.lit("key"), *key).cast("decimal(20,0)")).alias("sum_key")
    rows = df.groupBy(bucket_of(keys, buckets).alias("bucket"))
    return rows.agg(F.count(F.lit(1)).alias("n"), whole, *[checksum(c) for c in columns])


def rolled_up(leaves: DataFrame, factor: int = 2) -> DataFrame:
    """The tree of a level with ``factor`` times fewer buckets."""
    sums = [F.sum(c).alias(c) for c in leaves.columns if c != "bucket"]
    return leaves.groupBy(F.floor(F.col("bucket") / factor).cast("int").alias("bucket")).agg(*sums)


def unlike(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``bucket, column`` of what differs between two trees; ``(rows)`` for other keys or numbers of rows."""
    a, b = left.alias("a"), right.alias("b")
    both = a.join(b, "bucket", "full")

    def differs(name):
        return ~F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))

    found = [F.when(differs("n") | differs("sum_key"), F.lit(ROWS))]
    found += [F.when(differs(f"sum_{c}"), F.lit(c)) for c in columns]
    return both.select("bucket", F.explode(F.array_compact(F.array(*found))).alias("column"))


def differences(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    buckets: int = BUCKETS,
    trees: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """``*keys, column, value, copies``: cells that one side has more often.

    ``copies`` is positive for values of the right side and negative for those of the left; a changed cell
    gives one row of each. A row that one side lacks gives a row for every column and one for ``(rows)``.
    ``trees`` are stored trees of the two sides with as many buckets.
    """
    a, b = trees or (tree(left, keys, columns, buckets), tree(right, keys, columns, buckets))
    wanted = unlike(a, b, columns)
    names = [ROWS, *columns]
    marks = [F.max((F.col("column") == name).cast("int")).cast("string") for name in names]
    opened = wanted.groupBy("bucket").agg(F.concat(*marks).alias("__unlike"))

    def shown(df, sign):
        named = df.select(*keys, *[_shown(c).alias(c) for c in columns], F.lit(sign).alias("__sign"))
        named = named.withColumn("__bucket", bucket_of(keys, buckets))
        return named.join(opened, F.col("__bucket") == opened["bucket"])

    # Whole rows that both sides have cancel first, so only the others are taken apart into cells.
    both = shown(left, -1).unionByName(shown(right, 1))
    rows = both.groupBy(*keys, *columns, "__unlike").agg(F.sum("__sign").alias("__more"))
    values = [F.lit(None).cast("string"), *[F.col(c) for c in columns]]
    pairs = [
        F.struct(F.lit(k).alias("__at"), F.lit(name).alias("column"), value.alias("value"))
        for k, (name, value) in enumerate(zip(names, values), 1)
    ]
    wide = rows.where("__more <> 0").select(*keys, "__more", "__unlike", F.inline(F.array(*pairs)))
    live = wide.where(F.expr("substring(__unlike, __at, 1) = '1'"))
    sums = live.groupBy(*keys, "column", "value").agg(F.sum("__more").alias("copies"))
    return sums.where("copies <> 0")
