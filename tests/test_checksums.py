"""Checksum comparison, backfills and repeatable loads."""

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from cascata.operators import checksums
from cascata.sources import ledger, modes, scans, sinks, versions

KIND = "k long, g string, a string, b double"


def rows_of(rng, n):
    return [(rng.choice([None, *range(60)]), rng.choice("xyz"), rng.choice([None, "", "u", "v"]), rng.choice([None, 0.5, 1.5])) for _ in range(n)]


def by_hand(left, right, buckets_matter=False):
    """Cells that one side has more often, for all columns of rows with any difference in key counts."""
    cells = Counter()
    for rows, sign in ((left, -1), (right, 1)):
        for k, g, a, b in rows:
            cells[k, g, "(rows)", None] += sign
            cells[k, g, "a", a] += sign
            cells[k, g, "b", None if b is None else str(b)] += sign
    return {c: n for c, n in cells.items() if n}


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_differences(spark, buckets):
    rng = random.Random(buckets)
    left = rows_of(rng, 300)
    right = [r for r in left if rng.random() > 0.02]
    right = [(k, g, "changed", b) if rng.random() < 0.02 else (k, g, a, b) for k, g, a, b in right] + right[:3]
    rng.shuffle(right)
    a, b = spark.createDataFrame(left, KIND), spark.createDataFrame(right, KIND).repartition(5)
    found = checksums.differences(a, b, ["k", "g"], ["a", "b"], buckets)
    assert {(r.k, r.g, r.column, r.value): r.copies for r in found.collect()} == by_hand(left, right)
    assert checksums.differences(a, a.repartition(3), ["k", "g"], ["a", "b"], buckets).isEmpty()
    assert checksums.differences(a.limit(0), a.limit(0), ["k"], ["a"]).isEmpty()


def test_only_unlike_buckets_and_columns_are_opened(spark):
    a = spark.range(5000).select("id", (F.col("id") * 2).alias("v"), (F.col("id") % 7).alias("w"))
    b = a.withColumn("w", F.when(F.col("id").isin(17, 4000), 100).otherwise(F.col("w")).cast("long"))
    left, right = (checksums.tree(x, ["id"], ["v", "w"], 1024) for x in (a, b))
    wanted = checksums.unlike(left, right, ["v", "w"]).collect()
    assert {r.column for r in wanted} == {"w"} and len(wanted) == 2
    up = [checksums.rolled_up(t, 256) for t in (left, right)]
    assert up[0].count() == 4 and 1 <= checksums.unlike(*up, ["v", "w"]).count() <= 2
    found = checksums.differences(a, b, ["id"], ["v", "w"], 1024, (left, right))
    assert sorted((r.id, r.value, r.copies) for r in found.collect()) == sorted(
        [(17, "3", -1), (17, "100", 1), (4000, "3", -1), (4000, "100", 1)]
    )


def test_backfill_goes_on_where_it_stopped(spark, folder, monkeypatch):
    rows = spark.createDataFrame([(f"r{d}{n}", date(2024, 1, d)) for d in (1, 2, 3, 5, 9) for n in range(d)], "v string, dt date")
    book, table = ledger.Ledger(spark, f"{folder}/ledger"), modes.SourceTable("t", "dt")
    span = date(2024, 1, 1), date(2024, 1, 9)
    count = lambda: {str(r.dt): r["count"] for r in versions.read(spark, f"{folder}/t").groupBy("dt").count().collect()}
    real, calls = book.mark, []

    def dies(*args, **kwargs):
        calls.append(args)
        if len(calls) == 3:
            raise RuntimeError("the driver is gone")
        real(*args, **kwargs)

    monkeypatch.setattr(book, "mark", dies)
    with pytest.raises(RuntimeError):
        modes.backfill(spark, rows, table, folder, book, *span)
    monkeypatch.setattr(book, "mark", real)
    # The third day was written but not entered: it is done again, once.
    assert modes.work_list(rows, table, book, *span) == [date(2024, 1, 3), date(2024, 1, 5)]
    assert modes.backfill(spark, rows, table, folder, book, *span) == [date(2024, 1, 3), date(2024, 1, 5)]
    assert count() == {f"2024-01-0{d}": d for d in (1, 2, 3, 5)}
    assert modes.backfill(spark, rows, table, folder, book, *span) == []


def test_repeated_loads_leave_their_rows_once(spark, folder):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    sinks.append_once(rows, folder, "one")
    sinks.append_once(rows.limit(1), folder, "two")
    sinks.append_once(rows, folder, "one")
    found = Counter((r.v, r[sinks.TOKEN]) for r in scans.full_scan(spark, folder).collect())
    assert found == {("a", "one"): 2, ("b", "one"): 1, ("a", "two"): 1}
