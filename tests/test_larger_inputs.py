"""What larger tables need: views stored once, rows moved once, tasks of one size."""

import os
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cascata.operators import checksums, ordered
from cascata.operators.lookups import exact_or_latest
from cascata.operators.waterfall import ONE, Cube, Metric, Part, Role, Source, Waterfall
from cascata.plans import grids, refresh
from cascata.sources import scans, sinks
from checks import registry, tables
from checks import scans as scan_checks


def plan_of(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.fixture
def made(spark, tmp_path):
    """A few accounts with orders and lines."""
    orders = [
        (k, k % 7, "FOP"[k % 3], 100.0 + k, datetime(1995 + k % 3, 1 + k % 12, 1 + k % 28), "5-LOW") for k in range(60)
    ]
    lines = [
        (k % 60, k % 11, k % 5, 1 + k % 7, 50.0 + k, "ANR"[k % 3], "FO"[k % 2], datetime(1995 + k % 3, 1 + k % 12, 2 + k % 27))
        for k in range(180)
    ]
    kinds = {
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        "customer": "c_custkey long, c_name string", "supplier": "s_suppkey long, s_name string", "region": "r_regionkey int",
    }
    rows = {
        "orders": orders, "lineitem": lines, "customer": [(k, f"c{k}") for k in range(7)],
        "supplier": [(k, f"s{k}") for k in range(5)], "region": [(0,), (1,)],
    }
    for name, kind in kinds.items():
        spark.createDataFrame(rows[name], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_view_is_worked_out_once(spark, made):
    i = registry.Inputs(spark, made)
    assert i.kept("planos") is i.kept("planos")
    assert "Join" not in plan_of(i.kept("planos")) and "Join" in plan_of(i.view("planos"))
    assert Counter(i.kept("planos").collect()) == Counter(i.view("planos").collect())


def test_a_cube_reads_stored_rows(spark, made):
    cube = tables._cube(registry.Inputs(spark, made))
    plans = [plan_of(df) for df in (cube.sums, cube.ids)]
    assert all("Window" not in p for p in plans)


def test_changed_rows_take_one_grouping(spark):
    kind = "advertiser_id string, mes_base date, v double"
    day = date(2024, 1, 1)
    old = spark.createDataFrame([("a", day, 1.0)] * 3 + [("b", day, None), ("c", None, 2.0), (None, day, 1.0)], kind)
    new = spark.createDataFrame([("a", day, 1.0)] + [("b", day, None)] * 2 + [("c", None, 3.0), (None, day, 1.0)], kind)
    changed = refresh.changed_rows(old, new)
    expected = Counter({("a", day, 1.0): 2, ("b", day, None): 1, ("c", None, 2.0): 1, ("c", None, 3.0): 1})
    assert Counter(tuple(r) for r in changed.collect()) == expected
    assert plan_of(changed, "optimizedPlan").count("Aggregate") == 1
    assert changed.columns == old.columns


def test_plans_that_reach_a_month(spark):
    rows = [
        ("own", "1996-02-01", None), ("next", "1996-01-01", None), ("end", "1990-01-01", "1996-02-01"),
        ("far", "1996-03-01", "1996-04-01"), ("none", None, None), ("month end", "1996-01-31", None),
    ]
    df = spark.createDataFrame(rows, "k string, competencia string, mes_churn string")
    found = lambda *months: {r.k for r in refresh._plans_reaching(df, months).collect()}
    assert found(date(1996, 2, 1)) == {"own", "next", "end"}
    assert found(date(1996, 2, 29)) == {"month end"}
    assert "none" in found(None)


def test_rows_at_rest_are_not_written_again(spark, folder, monkeypatch):
    rows = [(k % 5, k % 3, date(2024, 1 + k % 9, 1), float(k)) for k in range(50)]
    df = spark.createDataFrame(rows, "a long, b long, day date, v double")
    df.write.parquet(folder)
    kept = spark.read.parquet(folder)
    plain = ordered.add_delta(kept, ["a"], ["day", "b"], "v", hot_rows=8)
    monkeypatch.setattr(ordered, "stored", lambda df: pytest.fail("written again"))
    found = ordered.add_delta(kept, ["a"], ["day", "b"], "v", hot_rows=8, at_rest=True)
    assert Counter(found.collect()) == Counter(plain.collect())


def test_default_plan_tables_write_their_rows_once(spark, made, monkeypatch):
    monkeypatch.setattr(ordered, "stored", lambda df: pytest.fail("written again"))
    for name in ("T6_planos_periodicos", "T7_bd_planos_periodicos"):
        bounded, default = (registry.QUERIES[n](spark, made).collect() for n in (name, f"{name}_default"))
        assert Counter(bounded) == Counter(default) and bounded


def test_a_row_enters_the_shuffle_once(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 3, "y"), (None, 1, None)], "k long, o long, v string")
    for pick, best in ((ordered.latest_per, "y"), (ordered.first_per, "x")):
        found = pick(df, ["k"], F.col("o"))
        assert "_by(" not in plan_of(found, "optimizedPlan")
        assert {(r.k, r.v) for r in found.collect()} == {(1, best), (None, None)}


def test_the_latest_row_comes_from_the_rows_by_date(spark):
    paid = spark.createDataFrame([("a", 1), ("a", 9), ("b", 1)], "id string, at int")
    history = spark.createDataFrame(
        [("a", 1, "p", 1), ("a", 1, "q", 0), ("a", 3, "r", 5), ("a", 3, "r", 7), ("a", None, "z", 9)], "id string, m int, x string, y int"
    )
    found = exact_or_latest(paid, history, "id", "at", "m")
    assert {tuple(r) for r in found.collect()} == {("a", 1, "q", 0), ("a", 9, "r", 7), ("b", 1, None, None)}
    # Grouped by date, and these rows by key.
    lines = [line for line in plan_of(found, "optimizedPlan").split("\n") if "Aggregate [" in line]
    assert len(lines) == 3 and sum("__best" in line for line in lines) == 3


def test_rows_that_both_sides_have_are_not_taken_apart(spark):
    kind = "k long, a string, b double"
    rows = [(k, "x", 0.5) for k in range(200)]
    left, right = spark.createDataFrame(rows, kind), spark.createDataFrame([(0, "y", 0.5), *rows[1:]], kind)
    found = checksums.differences(left, right, ["k"], ["a", "b"], 1)
    assert {tuple(r) for r in found.collect()} == {(0, "a", "x", -1), (0, "a", "y", 1)}
    plan = plan_of(found, "optimizedPlan").split("\n")
    cells = next(n for n, line in enumerate(plan) if "Generate inline" in line)
    assert any("Aggregate [k" in line for line in plan[cells:])


def test_differences_of_shown_values(spark):
    kind = "k long, b double"
    left, right = spark.createDataFrame([(1, 0.0)], kind), spark.createDataFrame([(1, -0.0)], kind)
    found = checksums.differences(left, right, ["k"], ["b"], 4)
    assert {(r.value, r.copies) for r in found.collect()} == {("0.0", -1), ("-0.0", 1)}


def test_buckets_grow_with_the_rows():
    assert sinks.buckets_for(0, 8) == 8 and sinks.buckets_for(800_001, 8) == 9
    assert sinks.buckets_for(54_000_000, 8) == 540


def test_exports_are_files_of_one_size(spark, made, monkeypatch):
    rows = {(str(r.o_orderkey), str(r.o_orderdate.date()), r.o_orderstatus) for r in spark.read.parquet(f"{made}/orders.parquet").collect()}
    monkeypatch.setattr(scan_checks, "EXPORT_ROWS", 7, raising=False)
    found = registry.QUERIES["S12_lines_by_place"](spark, made)
    assert sorted(tuple(r) for r in found.collect()) == sorted(rows)
    assert len(found.inputFiles()) > 3
    assert not any(os.path.basename(f).startswith("_") for f in found.inputFiles())


def test_lines_of_a_file_are_not_one_tasks(spark, tmp_path):
    (tmp_path / "one.csv").write_text("t\nname,day\n" + "".join(f"n{k},{k}\n" for k in range(50)))
    found = scans.csv_at(spark, str(tmp_path), ["name", "day"], 2)
    # Joined to its header without being dealt by file alone, whatever the sizes.
    assert "rightHint=(strategy=broadcast)" in plan_of(found, "optimizedPlan") and found.count() == 50


def test_what_a_cell_decides_is_not_summed():
    cube = grids.cube_of()
    decided = (grids.SIZED, grids.MOVED, grids.KEPT, grids.AT_ONCE)
    assert not [where for where, _ in cube.measures if any(test in where for test in decided)]
    # The terms still tell them apart.
    assert {p.cell for p in cube.parts} >= {None, grids.SIZED, grids.MOVED, f"{grids.SIZED} AND {grids.MOVED}"}


def test_cell_conditions_pick_grouped_rows(spark):
    rows = spark.createDataFrame(
        [("1", "a", "x", 1.0), ("1", "a", "x", 2.0), ("2", "a", "y", 4.0), (None, "a", None, 8.0), ("2", "b", "y", 16.0)],
        "who string, d string, s string, v double",
    )
    small, roles = "s = 'x'", {"HERE": Role({"D": "d"}, "TRUE")}
    metrics = [
        Metric("all", (Part("r", "HERE", "v > 1", "v"),)),
        Metric("small", (Part("r", "HERE", "v > 1", "v", cell=small), Part("r", "HERE", "TRUE", ONE, -1, cell="s <> 'x'"))),
        Metric("people", (Part("r", "HERE", "v > 0", ONE, 1, True, small), Part("r", "HERE", "TRUE", ONE, 1, True))),
    ]
    parts = [p for m in metrics for p in m.parts]
    cube = Cube(parts, "r", ["d", "s"])
    cube.sums, cube.ids = cube.sums_of(rows), cube.ids_of(rows, "who")
    for source in (
        Source(rows, roles, ["d", "s"], id="who"),
        Source(rows, roles, ["d", "s"], id="who", one_pass=True),
        Source(cube.sums, roles, ["d", "s"], id="who", cube=cube, id_frame=cube.ids),
    ):
        got = {tuple(r) for r in Waterfall(("D",), metrics, {"r": source}).build().collect()}
        assert got == {("a", 14.0, 1.0, 3), ("b", 16.0, -1.0, 1)}


def test_merged_ids_move_once(spark):
    cubes = [Cube([Part("s", "HERE", "v > 0", distinct=True)], "s", ["d"]) for _ in range(2)]
    for k, cube in enumerate(cubes):
        rows = spark.createDataFrame([("a", "1", 1), ("A", "1", 1), ("b", "2", k)], "d string, who string, v int")
        cube.sums, cube.ids = cube.sums_of(rows), sinks.stored(cube.ids_of(rows, "who"))
    merged = cubes[0].merge(cubes[1]).ids
    assert {tuple(r) for r in merged.collect()} == {("a", "1", 1), ("A", "1", 1), ("b", "2", 1)}
    wider = merged.groupBy(F.upper("d").alias("D"), "__id").agg(F.bit_or("__flags0").alias("f"))
    assert plan_of(wider).count("Exchange") == 1
    assert {tuple(r) for r in wider.collect()} == {("A", "1", 1), ("B", "2", 1)}


def test_sums_of_one_pass_leave_the_id(spark):
    rows = spark.createDataFrame([(k % 3, "a" if k < 9 else None, float(k)) for k in range(12)], "who int, d string, v double")
    rows = rows.unionByName(spark.createDataFrame([(None, "a", 100.0)], "who int, d string, v double"))
    metrics = [Metric("v", (Part("r", "HERE", "TRUE", "v"),)), Metric("n", (Part("r", "HERE", "v < 2", ONE, 1, True),))]
    source = Source(rows, {"HERE": Role({"D": "d"}, "d IS NOT NULL")}, ["d"], id="who", one_pass=True)
    found = Waterfall(("D",), metrics, {"r": source}).build()
    assert [tuple(r) for r in found.collect()] == [("a", 136.0, 2)]
    assert "END AS __id" in plan_of(found, "optimizedPlan")
