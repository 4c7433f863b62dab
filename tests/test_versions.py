"""Tables that outlive failed writes, cubes, refreshes and bucketed storage."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cascata.operators.waterfall import Cube, Metric, Part, Role, Source, Waterfall
from cascata.plans import grids, refresh, revenue
from cascata.sources import files, scans, sinks, versions
from checks.registry import Inputs

SF = "/root/testdata/sf0.001"


def fails_late(spark, n):
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_failed_write_keeps_the_old_rows(spark, folder):
    sinks.overwrite(spark.range(100), folder)
    reader = versions.read(spark, folder)
    with pytest.raises(Exception, match="broken"):
        sinks.overwrite(fails_late(spark, 50), folder)
    assert versions.read(spark, folder).count() == 100
    with pytest.raises(versions.Refused, match="too few"):
        sinks.overwrite(spark.range(7), folder, check=lambda df: ["too few"] if df.count() < 10 else [])
    assert versions.read(spark, folder).count() == 100
    sinks.overwrite(spark.range(30), folder, check=lambda df: ["too few"] if df.count() < 10 else [])
    # Who opened the version before goes on with it; what failed is gone.
    assert reader.count() == 100 and versions.read(spark, folder).count() == 30
    assert len(files.children(spark, f"{folder}/{versions.VERSIONS}")) == 2
    sinks.overwrite(spark.range(3), folder)
    assert len(versions.published(spark, folder)) == 2 == len(files.children(spark, f"{folder}/{versions.VERSIONS}"))


def test_plain_tables_and_appends(spark, folder):
    spark.range(5).write.parquet(folder)
    assert versions.read(spark, folder).count() == 5
    sinks.overwrite(spark.range(2), folder)
    sinks.append(spark.range(2), folder)
    assert versions.read(spark, folder).count() == 4
    assert files.children(spark, folder) == [versions.PUBLISHED, versions.VERSIONS]


def test_catalog_table_is_replaced(spark, folder):
    name = "t" + folder.rsplit("-", 1)[-1].replace("/", "_").replace("-", "_")
    sinks.save_table(spark.range(5), name, folder)
    sinks.save_table(spark.range(2), name, folder)
    assert spark.table(name).count() == 2
    with pytest.raises(Exception, match="broken"):
        sinks.save_table(fails_late(spark, 9), name, folder)
    assert spark.table(name).count() == 2
    sinks.save_table(spark.range(3).withColumn("more", F.lit("x")), name, folder)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_partitions_by_folder_name(spark, folder):
    rows = spark.createDataFrame([("a", date(2024, 1, 5)), ("b", date(2024, 1, 12)), ("c", None)], "v string, dt date")
    sinks.overwrite(rows, folder, "dt")
    assert scans.newest_partition(spark, folder) == date(2024, 1, 12)
    found = scans.snapshot(scans.full_scan(spark, folder), scans.newest_partition(spark, folder))
    assert [r.v for r in found.collect()] == ["b"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Subquery" not in plan
    assert scans.newest_partition(spark, folder + "/none") is None and scans.newest_day_folder(spark, folder) is None
    days = spark.createDataFrame([(2023, 12, 31), (2024, 2, 9), (2024, 10, 1)], "year int, month int, day int").withColumn("v", F.lit(1))
    days.write.partitionBy("year", "month", "day").parquet(folder + "2")
    assert scans.newest_day_folder(spark, folder + "2") == (2024, 10, 1)


def many_terms(n):
    return [Metric(f"m{k}", (Part("s", "HERE", f"v = {k}", distinct=True),)) for k in range(n)]


def test_more_than_one_word_of_distinct_terms(spark):
    rows = spark.range(3000).select((F.col("id") % 3).cast("string").alias("d"), (F.col("id") % 150).alias("v"), (F.col("id") % 700).alias("who"))
    want = {(r.d, r.v): r.n for r in rows.groupBy("d", "v").agg(F.countDistinct("who").alias("n")).collect()}
    terms, roles = many_terms(150), {"HERE": Role({"D": "d"}, "TRUE")}
    parts = [p for m in terms for p in m.parts]
    halves = [Cube(parts, "s", ["d"]) for _ in range(2)]
    for half, cube in enumerate(halves):
        mine = rows.where((F.col("v") + F.col("who")) % 2 == half)
        cube.sums, cube.ids = cube.sums_of(mine), cube.ids_of(mine, "who")
    merged = halves[0].merge(halves[1])
    sources = (
        {"s": Source(rows, roles, ["d"], id="who")},
        {"s": Source(rows, roles, ["d"], id="who", one_pass=True)},
        {"s": Source(merged.sums, roles, ["d"], id="who", cube=merged, id_frame=merged.ids)},
    )
    for source in sources:
        got = Waterfall(["D"], terms, source).build().collect()
        assert {(r.D, k): r[f"m{k}"] for r in got for k in range(150)} == {(d, k): want.get((d, k), 0) for d in "012" for k in range(150)}


def cells_of(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_null_sizes_by_version(spark):
    i = Inputs(spark, SF)
    bare = i.enriched().withColumn("tamanho_ajustado", F.lit(None).cast("string"))
    rows, paid, plans = sinks.stored(bare), i.payments(), i.view("planos").limit(0)
    assert rows.where("classificacao = 'Novo'").count() > 0
    full = grids.bd_full(rows, paid, plans).where("Tamanho = ''").agg(F.sum("novos_qtd"), F.sum("base_inicial_qtd"), F.count("*")).first()
    assert full[0] == 0 and full[1] != 0 and full[2] > 0
    full2 = grids.bd_full_v2(rows, paid, plans).where("Tamanho = ''").agg(F.sum("novos_qtd"), F.sum("base_inicial_qtd")).first()
    assert full2[0] > 0 and full2[1] != 0
    uf = grids.bd_planos_uf(rows, paid).agg(F.count_if(F.col("Tamanho").isNotNull()), F.sum("novos_qtd"), F.count("*")).first()
    assert uf[0] == 0 and uf[1] == 0 and uf[2] > 0


def test_touched_months(spark, folder):
    kind = "advertiser_id string, mes_base date, dt_cancelado date, v int"
    d = lambda m, y=2024: date(y, m, 1)
    old = spark.createDataFrame([("a", d(1), None, 1), ("b", d(12), d(3), 1), ("c", d(5), None, 1), ("c", d(5), None, 1)], kind)
    new = spark.createDataFrame([("a", d(1), None, 1), ("b", d(12), d(4), 1), ("c", d(5), None, 1), ("e", None, None, 1)], kind)
    changed = refresh.changed_rows(old, new)
    assert sorted(map(str, refresh.base_months(changed))) == ["2024-05-01", "2024-12-01", "None"]
    assert sorted(map(str, refresh.cell_months(changed))) == [
        "2024-03-01", "2024-04-01", "2024-05-01", "2024-06-01", "2024-12-01", "2025-01-01", "None"
    ]
    only = refresh.changed_rows(old, new, spark.createDataFrame([("b",)], "advertiser_id string"))
    assert only.count() == 2
    sinks.overwrite(old, folder, "mes_base")
    sinks.replace_values(new.where("mes_base = '2024-12-01' or mes_base is null"), folder, "mes_base", [d(12), d(5), None])
    assert sorted(str(r.mes_base) for r in versions.read(spark, folder).collect()) == ["2024-01-01", "2024-12-01", "None"]


def test_refresh_reads_few_partitions(spark, folder):
    i = Inputs(spark, SF)
    cube = refresh.store_cube(i.enriched(), folder)
    months = [date(1996, 7, 1)]
    small = refresh.narrowed(cube, months)
    reached = {r[0] for r in small.sums.select("mes_base").distinct().collect()}
    assert months[0] in reached and small.sums.count() < cube.sums.count() / 5


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_bucketed_rows_need_no_shuffle(spark, folder):
    i = Inputs(spark, SF)
    name = "b" + folder.rsplit("-", 1)[-1].replace("/", "_").replace("-", "_")
    gold = i.gold
    sinks.save_bucketed(gold, name, folder, ["advertiser_id"], ["mes_base"], 4)
    rows = spark.table(name)
    nothing = spark.createDataFrame([], "advertiser_id string, mes_base date, data_vencimento_cohort date, data_pagamento_cohort date")
    assert exchanges(revenue.tamanhos_ajustados(rows.withColumnRenamed("tamanho", "tamanho_ajustado"), unique_months=True)) == 0
    lagged = revenue.receita_enriquecida(rows, nothing, nothing, unique_months=True)
    plain = revenue.receita_enriquecida(gold, nothing, nothing, unique_months=True)
    assert exchanges(lagged) < exchanges(plain)
    assert lagged.exceptAll(plain).isEmpty() and plain.exceptAll(lagged).isEmpty()
    spark.sql(f"DROP TABLE {name}")
