"""Reconciliation of two frames: totals, groups, cells and snapshots.

Both sides are aggregated first, so only small results are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def totals(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """(metric, value): rounded sums, nulls as 0."""
    sums = df.agg(
        *[F.round(F.sum(F.coalesce(F.col(x), F.lit(0))), digits).cast("double").alias(x) for x in columns]
    )
    return sums.unpivot([], list(columns), "metric", "value")


def _sides(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    a = left.withColumnRenamed("value", "left_value")
    b = right.withColumnRenamed("value", "right_value")
    # Values are never null on their own side, so a null shows which side lacks the key.
    both = a.fillna(0.0, ["left_value"]).join(b.fillna(0.0, ["right_value"]), keys, how)
    lacking = F.when(F.col("left_value").isNull(), "left").when(F.col("right_value").isNull(), "right")
    filled = both.withColumn("lacking", lacking).fillna(0.0, ["left_value", "right_value"])
    return filled.withColumn("diff", F.col("right_value") - F.col("left_value"))


def compare_totals(
    left: DataFrame, right: DataFrame, columns: Sequence[str], tolerance: float = 0.01
) -> DataFrame:
    """Per column both totals, their difference and whether it is under the tolerance."""
    both = _sides(totals(left, columns), totals(right, columns), ["metric"], "inner").drop("lacking")
    return both.withColumn("matches", F.abs("diff") < tolerance)


def compare_groups(
    left: DataFrame, right: DataFrame, keys: list[str], columns: Sequence[str], how: str = "full"
) -> DataFrame:
    """Per group and column both sums and the signed difference.

    A group that one side lacks counts as 0 there and ``lacking`` names the side; ``how='inner'`` leaves
    such groups out. Null keys are groups of their own on either side.
    """

    def sums(df):
        grouped = df.groupBy(*keys).agg(*[F.sum(x).cast("double").alias(x) for x in columns])
        return grouped.unpivot(keys, list(columns), "metric", "value")

    return _sides(sums(left), sums(right), [*keys, "metric"], how)


def compare_cells(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str],
    share: float = 0.05,
    floor: float = 1.0,
) -> DataFrame:
    """Cell by cell: difference below ``share`` of the left value, or below ``floor``.

    A cell that one side lacks counts as 0 there, and ``lacking`` names the side.
    """

    def cells(df):
        cast = df.select(key, *[F.round(F.col(x).cast("double"), 0).alias(x) for x in columns])
        return cast.unpivot([key], list(columns), "metric", "value")

    both = _sides(cells(left), cells(right), [key, "metric"], "full")
    allowed = F.greatest(F.abs("left_value") * share, F.lit(floor))
    return both.withColumn("matches", F.abs("diff") < allowed)


def snapshot_state(df: DataFrame, column: str = "dt") -> DataFrame:
    return df.agg(F.max(column).alias("newest"), F.count(F.lit(1)).alias("n_rows"))


def compare_snapshots(left: DataFrame, right: DataFrame, column: str = "dt") -> DataFrame:
    """One row: newest date and rows of both sides, and whether the dates agree.

    Both sides are single rows by construction, so the cross join has one row.
    """
    a, b = snapshot_state(left, column), snapshot_state(right, column)
    named = a.select(F.col("newest").alias("left_newest"), F.col("n_rows").alias("left_rows"))
    other = b.select(F.col("newest").alias("right_newest"), F.col("n_rows").alias("right_rows"))
    same = F.col("left_newest").eqNullSafe(F.col("right_newest"))
    return named.crossJoin(other).withColumn("in_sync", same)
