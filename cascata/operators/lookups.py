"""Membership flags, exact-or-latest lookups and key sets, all as equi joins.

No side is broadcast by hint: Spark compares the measured size with
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge join, which AQE splits
on skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.operators.ordered import latest_per


def add_member_flag(df: DataFrame, key: str, members: DataFrame, name: str) -> DataFrame:
    """Boolean column: is ``key`` among the keys of ``members``? Null keys are not."""
    ids = (
        members.select(F.col(key).alias("__member"))
        .where(F.col("__member").isNotNull())
        .distinct()
    )
    return (
        df.join(ids, F.col(key).cast("string") == F.col("__member").cast("string"), "left")
        .withColumn(name, F.col("__member").isNotNull())
        .drop("__member")
    )


def keys_of_both(df: DataFrame, key: str, now: Column, ever: Column) -> DataFrame:
    """Keys that have a row where ``now`` holds and some row where ``ever`` holds.

    One aggregate over one scan instead of two filtered key sets and a semi join.
    """
    flags = df.groupBy(key).agg(F.bool_or(now).alias("__now"), F.bool_or(ever).alias("__ever"))
    return flags.where(F.col(key).isNotNull() & F.col("__now") & F.col("__ever")).select(key)


def exact_or_latest(
    df: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    history_at: str,
) -> DataFrame:
    """Per row the history row of exactly that date, else the key's latest history row.

    Two equi joins against one row per (key, date) and one row per key, so no OR condition and
    no ranking of candidates is needed.
    """
    values = [c for c in history.columns if c not in (key, history_at)]
    known = history.where(F.col(key).isNotNull())
    by_date = latest_per(known, [key, history_at], F.col(history_at))
    exact = by_date.select(
        F.col(key).alias("__xk"), F.col(history_at).alias("__xd"), F.struct(*values).alias("__x")
    )
    # The latest row is the latest of the dates' rows, which both lookups then share.
    latest = latest_per(by_date, [key], F.col(history_at)).select(
        F.col(key).alias("__lk"), F.struct(*values).alias("__l")
    )
    joined = df.join(
        exact, (F.col(key) == F.col("__xk")) & (F.col(at) == F.col("__xd")), "left"
    ).join(latest, F.col(key) == F.col("__lk"), "left")
    chosen = F.coalesce(F.col("__x"), F.col("__l"))
    return joined.select(*df.columns, *[chosen.getField(c).alias(c) for c in values])


def distinct_keys(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.select(*keys).distinct()


def union_distinct(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.distinct()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
