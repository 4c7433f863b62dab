"""Load ledger: an append-only table of finished loads."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata.schemas import declare

SCHEMA = declare(
    "table_name string, last_extraction_date date, rows_extracted bigint, "
    "extraction_type string, status string, updated_at timestamp",
    nullable=False,
)
SUCCESS, SKIPPED, VALUES_LOST = "success", "skip_zero_rows", "values_lost"


def successes(ledger: DataFrame, table: str) -> DataFrame:
    return ledger.where((F.col("table_name") == table) & (F.col("status") == SUCCESS))


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], SCHEMA).write.mode("ignore").parquet(path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def is_first_load(self, table: str) -> bool:
        """No successful load yet. A ledger that cannot be read fails: a first load overwrites."""
        return successes(self.read(), table).isEmpty()

    def mark(
        self,
        table: str,
        day: date,
        rows: int,
        kind: str,
        status: str = SUCCESS,
        at: datetime | None = None,
    ) -> None:
        """``at`` is the time of the load; without it the cluster's clock is read as the row is written."""
        row = (table, day, rows, kind, status, at or datetime(1970, 1, 1))
        frame = self.spark.createDataFrame([row], SCHEMA)
        if at is None:
            frame = frame.withColumn("updated_at", F.current_timestamp())
        frame.write.mode("append").parquet(self.path)
