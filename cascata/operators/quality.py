"""Quality gate: independent checks, each one row of (check, passed, message)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.operators.lookups import union_all


def _result(df: DataFrame, name: str, passed: Column, message: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.concat(F.lit(f"{name}: "), message).alias("message"),
    )


def has_rows(name: str, df: DataFrame) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return _result(counted, name, F.col("n") > 0, F.concat(F.col("n").cast("string"), F.lit(" rows")))


def is_fresh(name: str, df: DataFrame, column: str, as_of: date, days: int = 1) -> DataFrame:
    """The newest date is at most ``days`` days old; no date at all fails."""
    newest = df.agg(F.max(F.col(column).cast("date")).alias("newest"))
    shown = F.coalesce(F.col("newest").cast("string"), F.lit("none"))
    return _result(
        newest,
        name,
        F.col("newest") >= F.date_sub(F.lit(as_of), days),
        F.concat(F.lit("newest "), shown),
    )


def gate(*checks: DataFrame) -> DataFrame:
    return union_all(checks)


def gate_passed(results: DataFrame) -> DataFrame:
    return results.agg(F.bool_and("passed").alias("passed"))


def run_gate(checks: dict[str, Callable[[], DataFrame]]) -> tuple[bool, list[str]]:
    """Run every check on its own. A check that fails to run counts as failed."""
    failures = []
    for name, build in checks.items():
        try:
            row = build().first()
            if not row["passed"]:
                failures.append(row["message"])
        except Exception as e:  # driver and executor errors alike
            failures.append(f"{name}: error in check, {type(e).__name__}")
    return not failures, failures
