from datetime import date, datetime

import pytest
from pyspark.sql import Row

from cascata import schemas
from cascata.sources import ledger, modes, scans, sinks, versions

DAY, NEXT = date(2024, 1, 15), date(2024, 1, 16)
SCHEMA = schemas.declare("v string, dt date")


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def stored(spark, path):
    return sorted(tuple(r) for r in versions.read(spark, path).select("v", "dt").collect())


def test_month_bounds():
    assert scans.month_bounds("2024-11") == (date(2024, 11, 1), date(2024, 12, 1))
    assert scans.month_bounds("2024-12") == (date(2024, 12, 1), date(2025, 1, 1))


def test_ranges_are_half_open(spark):
    df = rows(spark, ("a", DAY), ("b", NEXT), ("c", None))
    assert [r.v for r in scans.date_range(df, "dt", DAY, NEXT).collect()] == ["a"]
    assert [r.v for r in scans.previous_day(df, "dt", NEXT).collect()] == ["a"]
    assert [r.v for r in scans.partition_day(df, "dt", NEXT).collect()] == ["b"]


def test_latest_snapshot_of_nothing(spark):
    empty = rows(spark).unionByName(rows(spark, ("a", None)))
    assert scans.latest_snapshot(empty).isEmpty()
    with pytest.raises(Exception):
        scans.latest_snapshot(empty, strict=True).collect()


def test_latest_snapshot_prunes_partitions(spark, folder):
    sinks.overwrite(rows(spark, ("a", DAY), ("b", NEXT)), folder, "dt")
    latest = scans.latest_snapshot(scans.full_scan(spark, folder))
    assert [r.v for r in latest.collect()] == ["b"]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_newest_year_month_day(spark):
    df = spark.createDataFrame([(2001, 12, 31, "a"), (2002, 1, 2, "b"), (2001, 12, 30, "c")], "year int, month int, day int, v string")
    newest = scans.newest_day_number(df, date(2001, 6, 1))
    assert [r.v for r in scans.at_day_number(df, newest).collect()] == ["b"]
    y, m, d = scans.split_day_number(newest.scalar())
    assert tuple(df.limit(1).select(y, m, d).first()) == (2002, 1, 2)
    assert scans.newest_day_number(df, date(2003, 1, 1)).first()[0] is None


def test_overwrite_append_and_partition(spark, folder):
    sinks.overwrite(rows(spark, ("a", DAY), ("b", NEXT)), folder, "dt")
    sinks.overwrite_partition(rows(spark, ("c", DAY)), folder, "dt", DAY)
    assert stored(spark, folder) == [("b", NEXT), ("c", DAY)]
    sinks.overwrite_partition(rows(spark), folder, "dt", DAY)
    assert len(stored(spark, folder)) == 2  # an empty load changes nothing
    sinks.append(rows(spark, ("c", DAY)), folder, "dt")
    assert len(stored(spark, folder)) == 3  # append adds the row again
    sinks.append_new(rows(spark, ("c", DAY), ("d", DAY)), folder, ["v", "dt"], "dt")
    assert len(stored(spark, folder)) == 4
    sinks.overwrite(rows(spark, ("z", DAY)), folder, "dt")
    assert stored(spark, folder) == [("z", DAY)]


def test_partition_load_refuses_other_days(spark, folder):
    sinks.overwrite(rows(spark, ("a", DAY)), folder, "dt")
    with pytest.raises(Exception):
        sinks.overwrite_partition(rows(spark, ("x", NEXT)), folder, "dt", DAY)
    assert stored(spark, folder) == [("a", DAY)]


def test_snapshot_needs_a_dated_name(spark, folder):
    assert sinks.file_date("b/t/t_2024-01-15.csv") == "2024-01-15"
    assert sinks.file_date("b/t/t.csv") is None
    assert sinks.landing_path("t", DAY) == "t/t_2024-01-15.csv"
    assert sinks.overwrite_snapshot(rows(spark, ("a", DAY)), folder, "t/t_2024-01-15.csv")
    assert not sinks.overwrite_snapshot(rows(spark, ("b", DAY)), folder, "t/t.csv")
    assert stored(spark, folder) == [("a", DAY)]


def test_export(spark, folder):
    df = spark.createDataFrame([("a", 1, DAY, None), (None, 2, None, " x ")], "s string, n int, d date, t string")
    assert [tuple(r) for r in sinks.export_grid(df).collect()] == [("a", "1", "2024-01-15", ""), ("", "2", "", " x ")]
    assert sinks.export_csv(df, folder)
    lines = sorted(r.value for r in spark.read.text(folder).collect())
    assert [x for x in lines if x.startswith("s,")] and ",2,, x " in lines
    assert not sinks.export_csv(df.limit(0), folder + "2")


def test_csv_scan_and_locale_csv(spark, folder):
    spark.createDataFrame([("a,b",), ("1,x",), ("2,y",)], "value string").coalesce(1).write.text(folder)
    schema = schemas.declare("a int, b string")
    assert [tuple(r) for r in scans.csv_scan(spark, folder, schema).collect()] == [(1, "x"), (2, "y")]
    with pytest.raises(Exception):
        scans.csv_scan(spark, folder, schemas.declare("b int, a string")).collect()
    lines = ["Report,,", "day,city,total", '01/06/2026,X,"1.234,50"', "2026-06-02,Y,n/d", ",,", "31/02/2026,Z,7", ",W,8"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(folder + "2")
    got = scans.locale_csv(spark, folder + "2", ["day", "city", "total"], "day", ["total"], ["Report"])
    assert sorted(map(str, got.collect())) == sorted(
        str(Row(day=d, city=c, total=t))
        for d, c, t in ((date(2026, 6, 1), "X", 1234.5), (date(2026, 6, 2), "Y", 0.0), (None, "Z", 7.0), (None, "W", 8.0))
    )


def test_ledger(spark, folder):
    book = ledger.Ledger(spark, folder)
    assert book.is_first_load("t")
    book.mark("t", DAY, 0, "incremental", ledger.SKIPPED, datetime(2024, 1, 15, 1))
    assert book.is_first_load("t")
    book.mark("t", DAY, 5, "full")
    assert not book.is_first_load("t") and book.is_first_load("other")
    assert book.read().count() == 2


def test_choices():
    t = modes.SourceTable
    pick = modes.choose_scan
    assert pick(t("a", "dt", historical=True), False, "2024-01") == ("month_range", "bootstrap")
    assert pick(t("a", custom=True), False, "2024-01") == ("custom", "full")
    assert pick(t("a", "dt", always_full=True), False) == ("all_partitions", "full")
    assert pick(t("a", "dt", use_max_dt=True), True) == ("full", "full")
    assert pick(t("a", "dt"), True, "2024-01") == ("full", "full")
    assert pick(t("a", "dt"), True) == ("full", "full")
    assert pick(t("a", "dt"), False) == ("partition_day", "incremental")
    assert pick(t("a", "dt", use_yesterday=True), False) == ("previous_day", "incremental")
    sink = modes.choose_sink
    assert sink(t("a"), "bootstrap") == "append" and sink(t("a", historical=True), "full") == "overwrite"
    assert sink(t("a", historical=True), "incremental") == "append"
    assert sink(t("a", group="hourly"), "incremental") == "overwrite_partition"
    assert sink(t("a"), "incremental") == "overwrite_snapshot"
    tables = [t("a", group="hourly"), t("b"), t("c", group="all")]
    assert [x.name for x in modes.in_group(tables, "daily")] == ["b"]
    assert len(modes.in_group(tables, "all")) == 3


def test_load_keeps_yesterday_when_today_is_empty(spark, folder):
    source = rows(spark, ("a", DAY), ("b", NEXT))
    book = ledger.Ledger(spark, f"{folder}/ledger")
    table = modes.SourceTable("gold", "dt", group="hourly")
    load = lambda day: modes.load(spark, source, table, folder, book, day)
    assert [load(DAY), load(NEXT), load(date(2024, 1, 17))] == ["overwrite", "overwrite_partition", "skip_zero_rows"]
    assert stored(spark, f"{folder}/gold") == [("a", DAY), ("b", NEXT)]
    found = sorted((r.rows_extracted, r.status) for r in book.read().collect())
    assert found == [(0, "skip_zero_rows"), (1, "success"), (2, "success")]


def test_load_keeps_the_declared_types(spark, folder):
    book = ledger.Ledger(spark, f"{folder}/ledger")
    declared = schemas.declare("id string, n bigint, dt date")
    table = modes.SourceTable("t", "dt", historical=True, schema=declared)
    day = lambda n, d: spark.createDataFrame([("a", n, "x", d)], f"id string, n {'bigint' if isinstance(n, int) else 'string'}, more string, dt date")
    assert modes.load(spark, day(1, DAY), table, folder, book, DAY) == "overwrite"
    assert modes.load(spark, day("2", NEXT), table, folder, book, NEXT) == "append"
    found = versions.read(spark, f"{folder}/t")
    assert sorted((r.n, r.more) for r in found.collect()) == [(1, "x"), (2, "x")] and found.schema["n"].dataType.simpleString() == "bigint"
    last = date(2024, 1, 17)
    with pytest.raises(Exception, match="n is no bigint: many"):
        modes.load(spark, day("many", last), table, folder, book, last)
    lossy = modes.SourceTable("t", "dt", historical=True, schema=declared, lossy=True)
    assert modes.load(spark, day("many", last), lossy, folder, book, last) == "append"
    assert sorted((r.n is None, r.n) for r in versions.read(spark, f"{folder}/t").collect()) == [(False, 1), (False, 2), (True, None)]
    assert [r.rows_extracted for r in book.read().where("status = 'values_lost'").collect()] == [1]


def test_schema_tools(spark):
    df = spark.createDataFrame([("1", "x"), ("z", None)], "a string, extra string")
    schema = schemas.declare("a int, b date")
    assert schemas.drift(df, schema) == [("a", "int", "string"), ("b", "date", "absent"), ("extra", "absent", "string")]
    assert [tuple(r) for r in schemas.conform(df, schema).collect()] == [(1, None), (None, None)]
    assert [tuple(r) for r in schemas.lost_values(df, schema).collect()] == [("a", 1)]
    assert schemas.complete(df, schema).columns == ["a", "b", "extra"]
