"""Checks of scans, sinks, load modes, the ledger and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cascata import schemas
from cascata.functions import dates as D
from cascata.operators import checksums, quality, reconcile
from cascata.plans import chain, daily
from cascata.sources import ledger, modes, scans, sinks
from checks import fixtures as X
from checks import sql_parts as S
from checks.registry import check

LINES = "l_orderkey l_linenumber l_quantity l_extendedprice l_returnflag".split()
ORDER_DAY = "CAST(o_orderdate AS DATE) AS day"
ORDERS = f"SELECT o_orderkey, o_custkey, o_orderstatus, {ORDER_DAY} FROM orders"
PAIDS = S.doubles("antecipado", "no_mes", "transcorrido")


def orders(i):
    t = i.table("orders")
    return t.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))


def stored(i, df, partition=None):
    folder = sinks.scratch_folder(i.spark)
    sinks.overwrite(df, folder, partition)
    return folder


@check("S1_full_scan", f"SELECT {', '.join(LINES)} FROM lineitem")
def s1(i):
    return scans.full_scan(i.spark, f"{i.folder}/lineitem.parquet").select(*LINES)


@check(
    "S2_custom_scan",
    "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def s2(i):
    text = (
        "SELECT n_name, count(*) AS customers FROM {customer} JOIN {nation} "
        "ON c_nationkey = n_nationkey GROUP BY n_name"
    )
    return scans.custom_scan(i.spark, text, customer=i.table("customer"), nation=i.table("nation"))


@check("S3_partition_day_scan", X.with_views("paids") + f" SELECT {PAIDS} FROM paids WHERE dt = DATE '2001-07-01'")
def s3(i):
    folder = stored(i, i.view("paids"), "dt")
    return scans.partition_day(scans.full_scan(i.spark, folder), "dt", date(2001, 7, 1))


@check("S4_all_partitions_scan", X.with_views("paids") + f" SELECT {PAIDS} FROM paids")
def s4(i):
    return scans.full_scan(i.spark, stored(i, i.view("paids"), "dt"))


@check("S4_partition_values", X.with_views("gold") + " SELECT DISTINCT mes_base FROM gold")
def s4_values(i):
    return scans.partition_values(i.gold, "mes_base")


@check("S5_date_range_scan", f"SELECT * FROM ({ORDERS}) WHERE day >= DATE '1995-03-10' AND day < DATE '1997-02-01'")
def s5(i):
    return scans.date_range(orders(i), "day", date(1995, 3, 10), date(1997, 2, 1))


@check("S6_month_range_scan", f"SELECT * FROM ({ORDERS}) WHERE year(day) = 1996 AND month(day) = 12")
def s6(i):
    return scans.month_range(orders(i), "day", "1996-12")


@check("S7_latest_snapshot_scan", X.with_views("paids") + f" SELECT {PAIDS} FROM paids WHERE dt = (SELECT max(dt) FROM paids)")
def s7(i):
    return scans.latest_snapshot(scans.full_scan(i.spark, stored(i, i.view("paids"), "dt")), strict=True)


@check("S8_previous_day_scan", f"SELECT * FROM ({ORDERS}) WHERE day = DATE '1996-03-01' - INTERVAL 1 DAY")
def s8(i):
    return scans.previous_day(orders(i), "day", date(1996, 3, 1))


@check(
    "S9_newest_year_month_day",
    X.with_views("opportunity")
    + """, n AS (SELECT max(year * 10000 + month * 100 + day) AS m FROM opportunity WHERE year >= 2000)
 SELECT accountid, uniqueopportunityidentifier__c, year, month, day, m // 10000 AS max_year, (m % 10000) // 100 AS max_month,
 m % 100 AS max_day FROM opportunity, n WHERE year = m // 10000 AND month = (m % 10000) // 100 AND day = m % 100""",
)
def s9(i):
    deals = i.view("opportunity")
    newest = scans.newest_day_number(deals, X.AS_OF)
    y, m, d = scans.split_day_number(newest.scalar())
    return scans.at_day_number(deals, newest).select(
        "accountid", "uniqueopportunityidentifier__c", "year", "month", "day",
        y.alias("max_year"), m.alias("max_month"), d.alias("max_day"),
    )


@check("S10_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def s10(i):
    rows = i.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    folder = sinks.scratch_folder(i.spark)
    rows.write.csv(folder, header=True)
    schema = schemas.declare("c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string")
    return scans.csv_scan(i.spark, folder, schema)


@check("S11_parquet_round_trip", ORDERS)
def s11(i):
    return scans.full_scan(i.spark, stored(i, orders(i)), orders(i).schema)


@check(
    "S12_locale_csv",
    X.with_views("gold")
    + """ SELECT CASE WHEN canal_conta <> 'Online' THEN mes_base END AS mes, canal_conta AS canal, CAST(coalesce(delta, 0) AS DOUBLE) AS delta,
 CAST(faturado_mes AS DOUBLE) AS faturado FROM gold""",
)
def s12(i):
    def comma(name):
        swapped = F.translate(F.format_number(F.col(name), 2), ",.", ".,")
        return F.concat(F.lit('"'), F.coalesce(swapped, F.lit("n/d")), F.lit('"'))

    shown = F.when(F.col("canal_conta") == "Online", "31/02/1996").otherwise(D.show_date(F.col("mes_base")))
    line = F.concat_ws(",", shown, "canal_conta", comma("delta"), comma("faturado_mes"))
    data = i.gold.select(line.alias("value"))
    titles = data.limit(0).unionByName(
        data.agg(F.explode(F.array(*[F.lit(t) for t in ("Report,,,", ",,,", "mes,canal,delta,faturado")])).alias("value"))
    )
    folder = sinks.scratch_folder(i.spark)
    titles.unionByName(data).write.text(folder)
    return scans.locale_csv(
        i.spark, folder, ["mes", "canal", "delta", "faturado"], "mes", ["delta", "faturado"], ["Report"]
    )


@check("S13_overwrite", f"SELECT * FROM ({ORDERS}) WHERE o_orderstatus = 'O'")
def s13(i):
    folder = stored(i, orders(i))
    sinks.overwrite(orders(i).where("o_orderstatus = 'O'"), folder)
    return scans.full_scan(i.spark, folder)


@check("S14_snapshot_overwrite", f"SELECT * FROM ({ORDERS}) WHERE o_orderstatus = 'F'")
def s14(i):
    """The undated file name is refused, the dated one replaces the table."""
    folder = stored(i, orders(i))
    sinks.overwrite_snapshot(orders(i).where("o_orderstatus = 'F'"), folder, "orders/orders_1998-01-02.csv")
    sinks.overwrite_snapshot(orders(i).where("o_orderstatus = 'O'"), folder, "orders/orders.csv")
    return scans.full_scan(i.spark, folder)


@check(
    "S15_partition_overwrite",
    X.with_views("paids")
    + " SELECT dt, advertiser_id, mes_pago, status_ts FROM paids WHERE dt <> DATE '2001-07-01' OR status_ts = '1-Paid'",
)
def s15(i):
    rows = i.view("paids").select("dt", "advertiser_id", "mes_pago", "status_ts")
    folder = stored(i, rows, "dt")
    day = date(2001, 7, 1)
    sinks.overwrite_partition(
        rows.where((F.col("dt") == F.lit(day)) & (F.col("status_ts") == "1-Paid")), folder, "dt", day
    )
    return scans.full_scan(i.spark, folder)


@check("S16_append", f"SELECT * FROM ({ORDERS}) UNION ALL SELECT * FROM ({ORDERS}) WHERE o_orderstatus = 'P'")
def s16(i):
    folder = stored(i, orders(i))
    sinks.append(orders(i).where("o_orderstatus = 'P'"), folder)
    return scans.full_scan(i.spark, folder)


@check("S16_append_new", ORDERS)
def s16_new(i):
    folder = stored(i, orders(i).where("o_orderstatus <> 'P'"))
    sinks.append_new(orders(i), folder, ["o_orderkey"])
    return scans.full_scan(i.spark, folder)


GOLD_SOURCE = modes.SourceTable("gold", "dt", group=modes.HOURLY, always_full=False)


def _loads(i, *days, month=None):
    """Load the gold view as an hourly source, on the given days."""
    folder = sinks.scratch_folder(i.spark)
    book = ledger.Ledger(i.spark, f"{folder}/ledger")
    rows = i.gold.select("advertiser_id", "mes_base", F.col("mes_base").alias("dt"))
    for day in days:
        modes.load(i.spark, rows, GOLD_SOURCE, folder, book, day, month)
    return folder, book


@check("S17_zero_row_skip", X.with_views("gold") + " SELECT advertiser_id, mes_base, mes_base AS dt FROM gold")
def s17(i):
    """The second day has no rows: nothing is replaced."""
    folder, _ = _loads(i, date(1996, 1, 1), date(2099, 1, 1))
    return scans.full_scan(i.spark, f"{folder}/gold")


@check("S18_derived_table_sink", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def s18(i):
    return scans.full_scan(i.spark, stored(i, i.table("orders").groupBy("o_custkey").agg(F.count("*").alias("n"))))


@check("S19_create_or_replace_table", f"SELECT * FROM ({ORDERS}) WHERE o_orderstatus <> 'P'")
def s19(i):
    """Replaced table under a folder of its own, as the catalog's default may be machine-local."""
    folder = sinks.scratch_folder(i.spark)
    name = f"cascata_{folder.rsplit('-', 1)[-1]}"
    sinks.save_table(orders(i), name, folder)
    sinks.save_table(orders(i).where("o_orderstatus <> 'P'"), name, folder)
    i.spark.sql(f"DROP TABLE {name}")
    return scans.full_scan(i.spark, folder)


@check(
    "S20_scan_and_sink_choice",
    X.with_views("gold", "planos")
    + """ SELECT 'gold' AS source, count(*) AS n FROM gold
 UNION ALL SELECT 'planos', (SELECT count(*) FROM planos)
 UNION ALL SELECT 'paids_months', (SELECT count(*) FROM gold WHERE mes_base IN (DATE '1995-12-01', DATE '1996-01-01'))""",
)
def s20(i):
    """First full load, a load of all snapshots and two month bootstraps; a bootstrap of a table that is not historical."""
    folder, book = _loads(i, date(1996, 1, 1))
    plans = modes.SourceTable("planos", "dt", use_max_dt=True, historical=True)
    modes.load(i.spark, i.view("planos"), plans, folder, book, X.AS_OF)
    months = modes.SourceTable("paids_months", "mes_base", historical=True)
    for month in ("1995-12", "1996-01"):
        modes.load(i.spark, i.gold, months, folder, book, X.AS_OF, month)
        current = modes.SourceTable("gold", "dt", group="hourly")
        modes.load(i.spark, i.gold, current, folder, book, X.AS_OF, month)
    counts = [
        scans.full_scan(i.spark, f"{folder}/{n}").agg(F.lit(n).alias("source"), F.count("*").alias("n"))
        for n in ("gold", "planos", "paids_months")
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@check("S21_hourly_partition_load", X.with_views("gold") + " SELECT advertiser_id, mes_base, mes_base AS dt FROM gold")
def s21(i):
    """Full load, then the same day again: the day is replaced, not doubled."""
    folder, _ = _loads(i, date(1996, 1, 1), date(1996, 1, 1))
    return scans.full_scan(i.spark, f"{folder}/gold")


@check(
    "S22_load_ledger",
    X.with_views("gold")
    + """ SELECT 'gold' AS table_name, DATE '1996-01-01' AS last_extraction_date, count(*) AS rows_extracted, 'full' AS extraction_type, 'success' AS status FROM gold
 UNION ALL SELECT 'gold', DATE '1996-02-01', count(*), 'incremental', 'success' FROM gold WHERE mes_base = DATE '1996-02-01'
 UNION ALL SELECT 'gold', DATE '2099-01-01', 0, 'incremental', 'skip_zero_rows'""",
)
def s22(i):
    _, book = _loads(i, date(1996, 1, 1), date(1996, 2, 1), date(2099, 1, 1))
    return book.read().drop("updated_at")


@check("S23_date_of_file", f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN day END AS file_date FROM ({ORDERS})")
def s23(i):
    ending = F.when(F.col("o_orderkey") % 3 > 0, ".csv").otherwise(".txt")
    path = F.concat(F.lit("orders/orders_"), F.col("day").cast("string"), ending)
    return orders(i).select("o_orderkey", scans.date_of_file(path).alias("file_date"))


@check("S24_dated_layout", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1")
def s24(i):
    rows = orders(i).withColumn("month", D.month_start(F.col("day")))
    back = scans.full_scan(i.spark, stored(i, rows, "month"))
    day = F.regexp_extract("_metadata.file_path", r"month=(\d{4}-\d{2}-\d{2})", 1)
    return back.groupBy(day.cast("date").alias("month")).agg(F.count("*").alias("n"))


@check(
    "S25_ordered_chain",
    X.with_views("gold", "silver_cb", "radar")
    + """, c AS (SELECT dt FROM radar WHERE base_date IS NOT NULL)
 SELECT 'radar_cohort' AS name, 'done' AS status, count(*) AS n FROM c
 UNION ALL SELECT 'receita_consolidada', 'done', (SELECT count(*) FROM gold) + (SELECT count(*) FROM silver_cb)
 UNION ALL SELECT 'planos_periodicos', 'blocked', NULL""",
)
def s25(i):
    """Two tables run; the one whose source is missing is reported and stops nothing."""
    folder = sinks.scratch_folder(i.spark)
    names = ("radar_cohort", "planos_periodicos", "receita_consolidada")
    steps = [s for s in chain.STEPS if s.name in names]
    sources = {n: i.view(n) for n in ("gold", "silver_cb", "radar")}
    outcomes = chain.run_chain(i.spark, sources, folder, X.AS_OF, steps)
    out = None
    for o in outcomes:
        if o.status == chain.DONE:
            n = scans.full_scan(i.spark, f"{folder}/{o.name}").agg(F.count("*").alias("n"))
        else:
            n = i.view("radar").agg(F.lit(None).cast("bigint").alias("n"))
        row = n.select(F.lit(o.name).alias("name"), F.lit(o.status).alias("status"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@check("S26_cadence_filter", X.with_views("gold") + " SELECT 'gold' AS table_name, count(*) AS rows_extracted FROM gold")
def s26(i):
    """Only tables of the hourly group are loaded."""
    tables = [GOLD_SOURCE, modes.SourceTable("radar", "dt"), modes.SourceTable("other", group=modes.ALL)]
    folder = sinks.scratch_folder(i.spark)
    book = ledger.Ledger(i.spark, f"{folder}/ledger")
    for t in modes.in_group(tables, modes.HOURLY):
        modes.load(i.spark, i.view(t.name), t, folder, book, X.AS_OF)
    return book.read().select("table_name", "rows_extracted")


EXPORTED = "advertiser_id mes_base estado faturado_mes delta dt_cancelado".split()


@check(
    "S27_tabular_export",
    X.with_views("gold")
    + " SELECT "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in EXPORTED)
    + " FROM gold",
)
def s27(i):
    folder = sinks.scratch_folder(i.spark)
    sinks.export_csv(i.gold.select(*EXPORTED), folder)
    back = i.spark.read.csv(folder, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in EXPORTED])


@check(
    "S28_quality_gate",
    X.with_views("gold", "silver_cb")
    + """ SELECT 'gold_rows' AS "check", count(*) > 0 AS passed, 'gold_rows: ' || CAST(count(*) AS VARCHAR) || ' rows' AS message FROM gold
 UNION ALL SELECT 'gold_fresh', max(dt) >= DATE '2001-08-01', 'gold_fresh: newest ' || CAST(max(dt) AS VARCHAR) FROM gold
 UNION ALL SELECT 'gold_stale', max(dt) >= DATE '2001-08-02', 'gold_stale: newest ' || CAST(max(dt) AS VARCHAR) FROM gold
 UNION ALL SELECT 'silver_rows', count(*) > 0, 'silver_rows: ' || CAST(count(*) AS VARCHAR) || ' rows' FROM silver_cb
 UNION ALL SELECT 'none_rows', FALSE, 'none_rows: 0 rows'""",
)
def s28(i):
    return quality.gate(
        quality.has_rows("gold_rows", i.gold),
        quality.is_fresh("gold_fresh", i.gold, "dt", date(2001, 8, 2)),
        quality.is_fresh("gold_stale", i.gold, "dt", date(2001, 8, 3)),
        quality.has_rows("silver_rows", i.view("silver_cb")),
        quality.has_rows("none_rows", i.gold.where("canal_conta = 'none'")),
    )


@check(
    "S29_snapshot_sync",
    X.with_views("paids", "planos")
    + """ SELECT (SELECT max(dt) FROM paids) AS left_newest, (SELECT count(*) FROM paids) AS left_rows,
 (SELECT max(dt) FROM planos) AS right_newest, (SELECT count(*) FROM planos) AS right_rows, TRUE AS in_sync""",
)
def s29(i):
    return reconcile.compare_snapshots(i.view("paids"), i.view("planos"))


TOTALS = "faturado_mes pago_mes_campanha pago_mes_bairro pago_mes_topo faturado_mes_campanha".split()


@check(
    "S30_reconcile_totals",
    X.with_views("gold")
    + ", s(metric, a, b) AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}', CAST(coalesce(sum({c}), 0) AS DOUBLE), CAST(coalesce(sum({c}) FILTER (canal_conta <> 'ND' OR {c} = 0), 0) AS DOUBLE) FROM gold"
        for c in TOTALS
    )
    + ") SELECT metric, a AS left_value, b AS right_value, round(b - a, 2) AS diff, abs(b - a) < 0.01 AS matches FROM s",
)
def s30(i):
    lacking = i.gold.where("canal_conta <> 'ND'")
    found = reconcile.compare_totals(i.gold, lacking, TOTALS)
    return found.withColumn("diff", F.round("diff", 2))


@check(
    "S31_reconcile_groups",
    X.with_views("gold", "silver_cb")
    + """, a AS (SELECT canal_conta, 'faturado_mes' AS metric, CAST(sum(faturado_mes) AS DOUBLE) AS left_value FROM gold GROUP BY 1),
 b AS (SELECT canal_conta, CAST(sum(pago_mes) AS DOUBLE) AS right_value FROM silver_cb WHERE canal_conta <> 'ND' GROUP BY 1)
 SELECT canal_conta, 'faturado_mes' AS metric, coalesce(left_value, 0) AS left_value, coalesce(right_value, 0) AS right_value,
 CASE WHEN left_value IS NULL THEN 'left' WHEN right_value IS NULL THEN 'right' END AS lacking,
 round(coalesce(right_value, 0) - coalesce(left_value, 0), 2) AS diff FROM a FULL JOIN b USING (canal_conta)""",
)
def s31(i):
    other = i.view("silver_cb").where("canal_conta <> 'ND'").withColumnRenamed("pago_mes", "faturado_mes")
    found = reconcile.compare_groups(i.gold, other, ["canal_conta"], ["faturado_mes"])
    return found.withColumn("diff", F.round("diff", 2))


PIVOTED = [
    (f"{kind}_{channel.lower()}", channel, day, column, label, value)
    for kind, day, column, label, value in (
        ("novo", "day_base", "classificacao", "Novo", "faturado_mes"),
        ("churn", "day_churn", "classificacao_churn", "CHURN", "faturado_mes"),
        ("upgrade", "day_base", "classificacao", "Upgrade", "delta"),
        ("downgrade", "day_base", "classificacao", "Downgrade", "delta"),
    )
    for channel in ("Field", "Inside", "Online", "ND")
]
LEFT_OUT = "estado <> 'RR' AND day(day_base) <> 13"


def _cells_sql() -> str:
    """Each side: a row per day of either date and pivot column; then a full join of both."""

    def side(name, rows):
        days = f"SELECT day_base AS Mes FROM {rows} WHERE day_base IS NOT NULL UNION SELECT day_churn FROM {rows} WHERE day_churn IS NOT NULL"
        cells = " UNION ALL ".join(
            f"SELECT d.Mes, '{metric}' AS metric, round(CAST(coalesce(sum(g.{value}), 0) AS DOUBLE)) AS {name}_value FROM {name}_days d "
            f"LEFT JOIN {rows} g ON g.{day} = d.Mes AND g.{column} = '{label}' AND g.canal_conta = '{channel}' GROUP BY 1"
            for metric, channel, day, column, label, value in PIVOTED
        )
        return f"{name}_days AS ({days}), {name}_cells AS ({cells})"

    other = f"(SELECT * FROM gold WHERE {LEFT_OUT})"
    return f""", {side('left', 'gold')}, {side('right', other)}
 SELECT Mes, metric, coalesce(left_value, 0) AS left_value, coalesce(right_value, 0) AS right_value,
 CASE WHEN left_value IS NULL THEN 'left' WHEN right_value IS NULL THEN 'right' END AS lacking,
 coalesce(right_value, 0) - coalesce(left_value, 0) AS diff,
 abs(coalesce(right_value, 0) - coalesce(left_value, 0)) < greatest(abs(coalesce(left_value, 0)) * 0.05, 1) AS matches
 FROM left_cells FULL JOIN right_cells USING (Mes, metric)"""


@check("S32_reconcile_cells", X.with_views("gold") + _cells_sql())
def s32(i):
    """All 16 columns of the daily pivot, by both dates."""
    return reconcile.compare_cells(
        daily.diarizacao(i.gold), daily.diarizacao(i.gold.where(LEFT_OUT)), "Mes", [p[0] for p in PIVOTED]
    )


@check(
    "S33_lost_values",
    X.with_views("planos")
    + """ SELECT 'package_name' AS "column", count(*) FILTER (TRY_CAST(package_name AS BIGINT) IS NULL AND package_name IS NOT NULL) AS lost FROM planos
 UNION ALL SELECT 'competencia', 0 UNION ALL SELECT 'canal', count(*) FILTER (canal IS NOT NULL) FROM planos""",
)
def s33(i):
    """Columns whose declared type does not fit the stored text."""
    return schemas.lost_values(
        i.view("planos"), schemas.declare("package_name bigint, competencia date, canal date")
    )


@check("S13_failed_write_keeps_rows", f"SELECT * FROM ({ORDERS}) WHERE o_orderstatus = 'O'")
def s13_failed(i):
    """The second write fails in a task, after others have written; readers still see the first."""
    folder = stored(i, orders(i).where("o_orderstatus = 'O'"))
    last = orders(i).agg(F.max("o_orderkey")).scalar()
    broken = orders(i).withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("unreadable"))).otherwise(F.col("o_orderstatus"))
    )
    try:
        sinks.overwrite(broken, folder)
    except Exception as e:  # the executor's error
        assert "unreadable" in str(e)
    return scans.full_scan(i.spark, folder)


def _order_counts(frames, day):
    return frames["orders"].groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def _broken(frames, day):
    failed = F.raise_error(F.lit("unreadable")).cast("bigint")
    return _order_counts(frames, day).withColumn("n", F.when(F.col("n") > 0, failed))


RUNS = "kept", "failing", "refused"


@check(
    "S18_failed_and_refused_builds_keep_rows",
    "WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)"
    + " UNION ALL ".join(
        f" SELECT '{name}' AS name, '{status}' AS status, o_orderstatus, n FROM {rows}"
        for name, status, rows in (
            ("kept", "done", "(SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)"),
            ("failing", "failed", "c"), ("refused", "refused", "c"),
        )
    ),
)
def s18_builds(i):
    """Three tables of a first run; in the second one build fails half-way and a check refuses another."""
    folder = sinks.scratch_folder(i.spark)
    before = {"orders": i.table("orders").where("o_orderstatus <> 'P'")}
    steps = [chain.Step(n, k, ("orders",), _order_counts) for k, n in enumerate(RUNS)]
    chain.run_chain(i.spark, before, folder, X.AS_OF, steps)
    steps[1] = chain.Step("failing", 1, ("orders",), _broken)
    checks = {"refused": lambda df: quality.has_rows("no_open_ones", df.where("o_orderstatus = 'none'"))}
    outcomes = chain.run_chain(i.spark, {"orders": i.table("orders")}, folder, X.AS_OF, steps, checks=checks)
    out = None
    for o in outcomes:
        rows = scans.full_scan(i.spark, f"{folder}/{o.name}")
        named = rows.select(F.lit(o.name).alias("name"), F.lit(o.status).alias("status"), "o_orderstatus", "n")
        out = named if out is None else out.unionByName(named)
    return out


@check(
    "S28_gate_and_export_of_a_group_run",
    X.with_views("gold", "radar")
    + """ SELECT 'gold' AS name, 'done' AS status, (SELECT count(*) FROM gold) AS n UNION ALL SELECT 'radar', 'done', (SELECT count(*) FROM radar)
 UNION ALL SELECT 'radar_cohort', 'done', (SELECT count(*) FROM radar WHERE base_date IS NOT NULL)
 UNION ALL SELECT 'planos_periodicos', 'blocked', NULL UNION ALL SELECT 'quality_gate', 'refused', NULL
 UNION ALL SELECT 'export:radar_cohort', 'done', (SELECT count(*) FROM radar WHERE base_date IS NOT NULL)
 UNION ALL SELECT 'export:planos_periodicos', 'blocked', NULL""",
)
def s28_group(i):
    """Loads, derived tables, a gate of which one check fails, and exports of what was built."""
    folder = sinks.scratch_folder(i.spark)
    book = ledger.Ledger(i.spark, f"{folder}/ledger")
    tables = [modes.SourceTable("gold", "dt", use_max_dt=True), modes.SourceTable("radar", "dt", use_max_dt=True)]
    steps = [s for s in chain.STEPS if s.name in ("radar_cohort", "planos_periodicos")]
    gate = {
        "cohort_rows": lambda f: quality.has_rows("cohort_rows", f["radar_cohort"]),
        "gold_fresh": lambda f: quality.is_fresh("gold_fresh", f["gold"], "dt", date(2001, 8, 9)),
    }
    outcomes = chain.run_group(
        i.spark, {n: i.view(n) for n in ("gold", "radar")}, tables, folder, book, X.AS_OF, steps=steps, gate=gate,
        exports=["radar_cohort", "planos_periodicos"],
    )
    out = None
    for o in outcomes:
        if o.status != chain.DONE:
            n = i.view("radar").agg(F.lit(None).cast("bigint").alias("n"))
        elif o.name.startswith(chain.EXPORT):
            n = i.spark.read.csv(f"{folder}/exports/{o.name.split(':')[1]}", header=True).agg(F.count("*").alias("n"))
        else:
            n = scans.full_scan(i.spark, f"{folder}/{o.name}").agg(F.count("*").alias("n"))
        row = n.select(F.lit(o.name).alias("name"), F.lit(o.status).alias("status"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@check(
    "S7_newest_partition_by_folder",
    X.with_views("paids") + " SELECT * EXCLUDE (antecipado, no_mes, transcorrido) FROM paids WHERE dt = (SELECT max(dt) FROM paids)",
)
def s7_folder(i):
    """The newest day is read off the folder names; rows of that day by a literal filter."""
    folder = stored(i, i.view("paids").drop("antecipado", "no_mes", "transcorrido"), "dt")
    newest = scans.newest_partition(i.spark, folder)
    return scans.snapshot(scans.full_scan(i.spark, folder), newest)


@check(
    "S9_newest_year_month_day_by_folder",
    X.with_views("opportunity") + " SELECT uniqueopportunityidentifier__c, year, month, day FROM opportunity WHERE month = 8",
)
def s9_folder(i):
    folder = sinks.scratch_folder(i.spark)
    rows = i.view("opportunity").select("uniqueopportunityidentifier__c", "year", "month", "day")
    rows.write.partitionBy("year", "month", "day").parquet(folder)
    return scans.at_day(scans.full_scan(i.spark, folder), scans.newest_day_folder(i.spark, folder))


COMPARED = "canal_conta tamanho faturado_mes estado classificacao".split()


@check(
    "S31_checksum_differences",
    X.with_views("gold")
    + """, b AS (SELECT advertiser_id, mes_base, canal_conta, tamanho, CASE WHEN day(day_base) = 13 THEN faturado_mes + 1 ELSE faturado_mes END AS faturado_mes,
 CASE WHEN estado = 'RR' THEN 'AM' ELSE estado END AS estado, classificacao FROM gold WHERE NOT (advertiser_id LIKE '%7' AND mes_base = DATE '1996-05-01')
 UNION ALL SELECT advertiser_id, mes_base, canal_conta, tamanho, faturado_mes, estado, classificacao FROM gold WHERE advertiser_id LIKE '%3' AND mes_base = DATE '1997-02-01'),
 c AS ("""
    + " UNION ALL ".join(
        f"SELECT advertiser_id, mes_base, '{name}' AS \"column\", {value} AS value, {sign} AS s FROM {side}"
        for side, sign in (("gold", -1), ("b", 1))
        for name, value in [("(rows)", "CAST(NULL AS VARCHAR)"), *((x, f"CAST({x} AS VARCHAR)") for x in COMPARED)]
    )
    + """)
 SELECT advertiser_id, mes_base, "column", value, CAST(sum(s) AS BIGINT) AS copies FROM c GROUP BY ALL HAVING sum(s) <> 0""",
)
def s31_checksums(i):
    """Changed cells, lost rows and doubled rows between two versions of a table, found by checksums."""
    keys = ["advertiser_id", "mes_base"]
    extra = i.gold.where("advertiser_id LIKE '%3' AND mes_base = DATE '1997-02-01'")
    kept = i.gold.where("NOT (advertiser_id LIKE '%7' AND mes_base = DATE '1996-05-01')").withColumns({
        "faturado_mes": F.when(F.dayofmonth("day_base") == 13, F.col("faturado_mes") + 1).otherwise(F.col("faturado_mes")).cast("decimal(18,2)"),
        "estado": F.when(F.col("estado") == "RR", "AM").otherwise(F.col("estado")),
    })
    return checksums.differences(i.gold, kept.unionByName(extra), keys, COMPARED)


BACKFILLED = modes.SourceTable("gold", "dt", historical=True)


@check(
    "S4_resumed_backfill",
    X.with_views("gold")
    + """ SELECT advertiser_id, dt, n FROM (SELECT advertiser_id, mes_base AS dt, count(*) AS n FROM gold GROUP BY ALL) WHERE dt >= DATE '1996-01-01' AND dt < DATE '1996-05-01'""",
)
def s4_backfill(i):
    """Two days, a day written but not entered as if the run had died there, then a run to the end."""
    folder = sinks.scratch_folder(i.spark)
    book = ledger.Ledger(i.spark, f"{folder}/ledger")
    rows = i.gold.select("advertiser_id", F.col("mes_base").alias("dt"))
    span = date(1996, 1, 1), date(1996, 5, 1)
    modes.backfill(i.spark, rows, BACKFILLED, folder, book, *span, at_most=2)
    third = modes.work_list(rows, BACKFILLED, book, *span)[0]
    sinks.overwrite_partition(scans.partition_day(rows, "dt", third), f"{folder}/gold", "dt", third)
    modes.backfill(i.spark, rows, BACKFILLED, folder, book, *span)
    found = scans.full_scan(i.spark, f"{folder}/gold")
    return found.groupBy("advertiser_id", "dt").agg(F.count("*").alias("n"))


@check(
    "S16_append_with_load_token",
    "SELECT o_custkey, o_orderstatus, 'orders-1998-01-0' || CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '2' END AS load_token "
    "FROM orders WHERE o_orderstatus IN ('F', 'O')",
)
def s16_token(i):
    """Two loads, of which the second runs twice; rows that repeat inside a load stay."""
    folder = sinks.scratch_folder(i.spark)
    book = ledger.Ledger(i.spark, f"{folder}/ledger")
    table = modes.SourceTable("orders", "dt", historical=True, repeatable=True)
    rows = i.table("orders").select("o_custkey", "o_orderstatus")
    for status, day in (("F", 1), ("O", 2), ("O", 2)):
        of_day = rows.where(F.col("o_orderstatus") == status).withColumn("dt", F.lit(date(1998, 1, day)))
        modes.load(i.spark, of_day, table, folder, book, date(1998, 1, day))
    return scans.full_scan(i.spark, f"{folder}/orders").drop("dt")


#: Rows of one exported file.
EXPORT_ROWS = 1_000_000


@check(
    "S12_lines_by_place",
    f"SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(day AS VARCHAR) AS day, o_orderstatus FROM ({ORDERS})",
)
def s12_place(i):
    """Exports with three title lines and the header on line four, columns in two orders; titles look like rows."""
    folder = sinks.scratch_folder(i.spark)
    for status, names in (("F", ["o_orderkey", "day", "o_orderstatus"]), ("O", ["o_orderstatus", "o_orderkey", "day"]), ("P", ["day", "o_orderkey", "o_orderstatus"])):
        rows = orders(i).where(F.col("o_orderstatus") == status).select(*[F.col(n).cast("string") for n in names])
        # As many exports as the rows fill, each with its titles; a file is one task's.
        files = max(1, -(-i.table("orders").count() // EXPORT_ROWS))
        part = F.pmod(F.xxhash64("o_orderkey"), F.lit(files)).cast("int").alias("part")
        lines = rows.select(part, F.lit(5).alias("k"), F.concat_ws(",", *names).alias("value"))
        titles = ["1,1996-01-01,F", "", "Report", ",".join(names)]
        top = i.table("region").limit(1).select(F.explode(F.sequence(F.lit(0), F.lit(files - 1))).alias("part"))
        top = top.select("part", F.posexplode(F.array(*map(F.lit, titles))).alias("k", "value"))
        dealt = top.unionByName(lines).repartition(files, "part").sortWithinPartitions("part", "k")
        dealt.select("part", "value").write.mode("append").partitionBy("part").text(folder)
    return scans.csv_at(i.spark, folder, ["o_orderkey", "day", "o_orderstatus"], header_line=4)


@check(
    "S33_type_turns",
    """SELECT 'c_phone' AS "column", DATE '1998-01-03' AS day, 'bigint' AS before, 'string' AS after
 UNION ALL SELECT 'c_acctbal', DATE '1998-01-04', NULL, 'double' WHERE (SELECT count(*) FROM customer) > 0""",
)
def s33_turns(i):
    """Four days of a table: a number turns into text on the third, a column comes on the fourth."""
    folder = sinks.scratch_folder(i.spark)
    for day in range(1, 5):
        rows = i.table("customer").select(
            "c_custkey", F.col("c_custkey").cast("bigint" if day < 3 else "string").alias("c_phone"),
            *([F.col("c_acctbal").cast("double").alias("c_acctbal")] if day == 4 else []),
        )
        rows.write.parquet(f"{folder}/dt=1998-01-0{day}")
    return scans.type_turns(scans.types_by_day(i.spark, folder))
