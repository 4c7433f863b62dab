"""Daily pivot of signed and cancelled amounts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PivotClass:
    """Output prefix, the date that places a row, the class it must have and its amount."""

    prefix: str
    date: str
    column: str
    equals: str
    value: str


def dated_pivot(
    df: DataFrame, classes: Sequence[PivotClass], across: str, values: Sequence[str], day: str
) -> DataFrame:
    """One row per date of any date column, one rounded sum per class and ``across`` value.

    A row matches a date through any of several date columns. Instead of an OR join with the list
    of dates, each row is emitted once per date column and grouped: one scan, one shuffle, and the
    sums collapse per task before it.
    """
    date_columns = list(dict.fromkeys(c.date for c in classes))
    used = list(dict.fromkeys([across, *(x for c in classes for x in (c.column, c.value))]))
    places = [
        F.struct(F.lit(name).alias("__by"), F.col(name).alias(day)) for name in date_columns
    ]
    placed = df.select(*used, F.inline(F.array(*places))).where(F.col(day).isNotNull())
    sums = []
    for c in classes:
        for v in values:
            hit = (F.col("__by") == c.date) & (F.col(c.column) == c.equals) & (F.col(across) == v)
            total = F.coalesce(F.sum(F.when(hit, F.col(c.value))), F.lit(0))
            sums.append(F.round(total, 0).alias(f"{c.prefix}_{v.lower()}"))
    return placed.groupBy(day).agg(*sums)
