"""Which scan reads a source and which sink stores it, as plain decision tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cascata import schemas
from cascata.sources import files, scans, sinks
from cascata.sources.ledger import SKIPPED, VALUES_LOST, Ledger

HOURLY, DAILY, ALL = "hourly", "daily", "all"
FULL, INCREMENTAL, BOOTSTRAP, BACKFILL = "full", "incremental", "bootstrap", "backfill"
#: A month bootstrap takes historical tables only; others are left as they are.
NOT_HISTORICAL = "not_historical"


@dataclass(frozen=True)
class SourceTable:
    name: str
    partition: str | None = None
    group: str = DAILY
    custom: bool = False
    always_full: bool = False
    use_max_dt: bool = False
    use_yesterday: bool = False
    historical: bool = False
    schema: StructType | None = None
    #: Values that the declared types cannot hold become null and are counted; else they fail the load.
    lossy: bool = False
    #: Appended rows carry the load's token, so a load that runs twice leaves its rows once.
    repeatable: bool = False


def in_group(tables: list[SourceTable], group: str) -> list[SourceTable]:
    """Tables of a cadence; 'all' selects every table."""
    return list(tables) if group == ALL else [t for t in tables if t.group == group]


def choose_scan(table: SourceTable, first: bool, bootstrap: str | None = None) -> tuple[str, str]:
    """(scan, extraction type). The first rule that fits wins."""
    rules = (
        (bool(bootstrap and table.partition and table.historical), ("month_range", BOOTSTRAP)),
        (table.custom, ("custom", FULL)),
        (table.always_full and bool(table.partition), ("all_partitions", FULL)),
        (table.use_max_dt, ("full", FULL)),
        (first or table.always_full, ("full", FULL)),
        (table.use_yesterday, ("previous_day", INCREMENTAL)),
        (True, ("partition_day", INCREMENTAL)),
    )
    return next(choice for fits, choice in rules if fits)


def choose_sink(table: SourceTable, extraction: str) -> str:
    rules = (
        (extraction == BOOTSTRAP, "append"),
        (extraction == FULL, "overwrite"),
        (table.historical, "append"),
        (table.group == HOURLY, "overwrite_partition"),
        (True, "overwrite_snapshot"),
    )
    return next(choice for fits, choice in rules if fits)


def read(source: DataFrame, table: SourceTable, scan: str, as_of: date, month: str | None = None):
    """Apply the chosen scan to a source frame."""
    column = table.partition
    return {
        "month_range": lambda: scans.month_range(source, column, month),
        "latest_snapshot": lambda: scans.latest_snapshot(source, column),
        "previous_day": lambda: scans.previous_day(source, column, as_of),
        "partition_day": lambda: scans.partition_day(source, column, as_of),
    }.get(scan, lambda: source)()


def load_token(table: SourceTable, as_of: date, month: str | None = None) -> str:
    """Names a load: table and day, or table and month of a bootstrap."""
    return f"{table.name}-{month or as_of.isoformat()}"


def work_list(source: DataFrame, table: SourceTable, ledger: Ledger, start: date, end: date) -> list[date]:
    """Days of the source from ``start`` up to ``end`` that no backfill has finished, oldest first."""
    done = (
        ledger.read()
        .where((F.col("table_name") == table.name) & (F.col("extraction_type") == BACKFILL))
        .select(F.col("last_extraction_date").alias(table.partition))
    )
    days = scans.date_range(source, table.partition, start, end).select(table.partition).distinct()
    return sorted(r[0] for r in days.join(done, table.partition, "left_anti").collect())


def backfill(
    spark: SparkSession,
    source: DataFrame,
    table: SourceTable,
    folder: str,
    ledger: Ledger,
    start: date,
    end: date,
    at_most: int | None = None,
) -> list[date]:
    """Load the days of a range one by one, each committed on its own; gives the days loaded.

    A day is written in place of what the table has of it and then entered in the ledger. A run that
    stops anywhere goes on with the next day: what is entered is not read again, and a day that was
    written but not entered is replaced, not doubled. ``at_most`` ends a run after so many days.
    """
    path, loaded = f"{folder.rstrip('/')}/{table.name}", []
    for day in work_list(source, table, ledger, start, end)[:at_most]:
        seen = Observation()
        rows = scans.partition_day(source, table.partition, day)
        if table.schema:
            rows = schemas.guard(rows, table.schema, table.lossy)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        if files.exists(spark, path):
            sinks.overwrite_partition(rows, path, table.partition, day)
        else:
            sinks.overwrite(rows, path, table.partition)
        ledger.mark(table.name, day, seen.get["rows"], BACKFILL)
        loaded.append(day)
    return loaded


def load(
    spark: SparkSession,
    source: DataFrame,
    table: SourceTable,
    folder: str,
    ledger: Ledger,
    as_of: date,
    month: str | None = None,
) -> str:
    """Scan, store and record one source table. Gives the sink used, or the skip status.

    With a declared schema the rows are stored in its types, also if the source changed a column's type.
    Of a lossy table the ledger gets one more row with the number of values lost, if there are any.
    """
    if month and not (table.historical and table.partition):
        return NOT_HISTORICAL
    scan, kind = choose_scan(table, ledger.is_first_load(table.name), month)
    frame = read(source, table, scan, as_of, month)
    path = f"{folder.rstrip('/')}/{table.name}"
    # Reads up to the first row only.
    if table.group == HOURLY and frame.isEmpty():
        ledger.mark(table.name, as_of, 0, kind, SKIPPED)
        return SKIPPED
    sink = choose_sink(table, kind)
    seen = Observation()
    held = [f for f in table.schema.fields if f.name in frame.columns] if table.schema else []
    lost = sum((schemas.unreadable(f).cast("long") for f in held), F.lit(0).cast("long"))
    frame = frame.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(lost).alias("lost"))
    if table.schema:
        frame = schemas.guard(frame, table.schema, table.lossy)
    if sink == "overwrite_partition":
        sinks.overwrite_partition(frame, path, table.partition, as_of)
    elif sink == "append":
        if table.repeatable:
            sinks.append_once(frame, path, load_token(table, as_of, month))
        else:
            sinks.append(frame, path, table.partition)
    elif sink == "overwrite_snapshot":
        sinks.overwrite_snapshot(frame, path, sinks.landing_path(table.name, as_of), table.partition)
    elif table.repeatable:
        sinks.overwrite(frame.withColumn(sinks.TOKEN, F.lit(load_token(table, as_of, month))), path, sinks.TOKEN)
    else:
        sinks.overwrite(frame, path, table.partition)
    ledger.mark(table.name, as_of, seen.get["rows"], kind)
    if seen.get["lost"]:
        ledger.mark(table.name, as_of, seen.get["lost"], kind, VALUES_LOST)
    return sink
