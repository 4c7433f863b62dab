"""Lines by place, type history, scratch folders and lags along nearly unique columns."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cascata.operators import ordered
from cascata.sources import files, scans, sinks


def test_lines_are_numbered_across_splits(spark, tmp_path):
    for name, n in (("a", 3000), ("b", 1), ("c", 0), ("d", 777)):
        (tmp_path / name).write_text("".join(f"{name} {k + 1} {'x' * (k % 50)}\n" for k in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2000", "100000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = scans.numbered_lines(spark, str(tmp_path)).collect()
            assert len(found) == 3778 and all(int(r.text.split()[1]) == r.line for r in found)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_header_on_a_given_line(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b\nx\n\nName , day,"n, o"\n"p, ""q""",2024-01-02,1\n\n,2024-01-03,"2"\n')
    (tmp_path / "two.csv").write_text('t\nt\nt\nday,name\n2024-01-04,z\n')
    found = scans.csv_at(spark, str(tmp_path), ["name", "day", "n, o"], 4).collect()
    assert sorted(tuple(r) for r in found if r.name != "") == [('p, "q"', "2024-01-02", "1"), ("z", "2024-01-04", None)]
    assert [tuple(r) for r in found if r.name == ""] == [("", "2024-01-03", "2")]
    assert scans.csv_at(spark, str(tmp_path), ["name"], 40).count() == 0


def test_types_that_turn(spark, folder):
    for k, kind in enumerate(("int", "int", "string", "int")):
        spark.range(3).select("id", F.col("id").cast(kind).alias("v")).write.parquet(f"{folder}/dt=2024-01-0{k + 1}")
    spark.range(3).select(F.col("id").cast("string").alias("v")).write.mode("append").parquet(f"{folder}/dt=2024-01-04")
    turns = {(r.column, str(r.day)): (r.before, r.after) for r in scans.type_turns(scans.types_by_day(spark, folder)).collect()}
    assert turns[("v", "2024-01-03")] == ("int", "string") and turns[("v", "2024-01-04")] == ("string", "mixed")


def test_scratch_goes_at_the_end(spark):
    with sinks.scratch(spark):
        path = sinks.stored(spark.range(4)).inputFiles()[0].rsplit("/", 1)[0]
        assert files.exists(spark, path)
    assert not files.exists(spark, path)


@pytest.mark.parametrize("order", [["at"], ["at", "n"], ["day"], ["day", "at"], ["flat", "n"]])
def test_lag_of_hot_keys_along_any_order(spark, order):
    start = datetime(2024, 1, 1)
    rows = [
        (k % 2, start + timedelta(seconds=k * 37 % 900), date(2024, 1, 1 + k % 3), 1, None if k % 50 == 0 else k % 40, k % 11)
        for k in range(1200)
    ]
    kind = "key int, at timestamp, day date, flat int, n int, v int"
    df = spark.createDataFrame(rows, kind).repartition(6)
    plain = ordered.add_previous(df, ["key"], order, {"before": "v"}, bounded=True)
    split = ordered.add_previous(df, ["key"], order, {"before": "v"}, hot_rows=10)
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_pieces_of_a_nearly_unique_column_are_few(spark):
    rows = spark.range(20000).select(F.lit(1).alias("key"), "id", F.xxhash64("id").alias("__hash"))
    pieces, names = ordered._with_ranges(rows, ["key"], ["id"])
    assert pieces.select(*names).distinct().count() <= 2 * ordered.PIECES
