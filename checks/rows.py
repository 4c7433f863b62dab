"""Checks of projections, predicates, column functions and business columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascata.functions import business as B
from cascata.functions import dates as D
from cascata.functions import text as T
from cascata.operators.ordered import add_previous
from cascata.plans import grids, payments, recurring
from checks import fixtures as X
from checks import sql_parts as S
from checks.registry import check

c = F.col
GOLD = X.with_views("gold")
PLANS = X.with_views("planos")
PAIDS = X.with_views("paids")
DEALS = X.with_views("opportunity")
ID = "advertiser_id, mes_base"


# ---- projections and predicates --------------------------------------------------------------


@check(
    "P1_project_rename_tag",
    GOLD + " SELECT 'receita' AS fonte, advertiser_id, cordenador AS coordenador, mes_base FROM gold",
)
def p1(i):
    return i.gold.select(
        F.lit("receita").alias("fonte"), "advertiser_id", c("cordenador").alias("coordenador"), "mes_base"
    )


@check(
    "P2_star_plus_columns",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS day, "
    "o_totalprice * 2 AS doubled FROM orders",
)
def p2(i):
    t = i.table("orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return t.withColumns({"doubled": c("o_totalprice") * 2}).withColumnRenamed("o_orderdate", "day")


@check(
    "P3_qualified_star",
    "SELECT n.*, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey",
)
def p3(i):
    n, r = i.table("nation").alias("n"), i.table("region").alias("r")
    return n.join(r, c("n.n_regionkey") == c("r.r_regionkey")).select("n.*", "r.r_name")


@check(
    "P4_searched_case",
    GOLD
    + f""" SELECT {ID}, CASE WHEN delta IS NULL THEN NULL WHEN delta > 0 THEN CASE WHEN status_ts = '1-Paid' THEN 'up paid' ELSE 'up' END ELSE 'other' END AS label FROM gold""",
)
def p4(i):
    up = F.when(c("status_ts") == "1-Paid", "up paid").otherwise("up")
    label = F.when(c("delta").isNull(), None).when(c("delta") > 0, up).otherwise("other")
    return i.gold.select("advertiser_id", "mes_base", label.alias("label"))


@check("P5_null_dropping_filter", GOLD + f" SELECT {ID}, tamanho FROM gold WHERE tamanho <> 'P' AND classificacao_churn = 'CHURN'")
def p5(i):
    kept = i.gold.where((c("tamanho") != "P") & (c("classificacao_churn") == "CHURN"))
    return kept.select("advertiser_id", "mes_base", "tamanho")


@check(
    "P6_filled_guard",
    GOLD + f" SELECT {ID}, cordenador FROM gold WHERE cordenador IS NOT NULL AND cordenador <> '' AND dt_cancelado IS NULL",
)
def p6(i):
    kept = i.gold.where(T.is_filled(c("cordenador")) & c("dt_cancelado").isNull())
    return kept.select("advertiser_id", "mes_base", "cordenador")


@check(
    "P7_in_and_not_in",
    PLANS
    + " SELECT id_conta_olx, id_contrato, competencia FROM planos WHERE status_recorrente IN ('flat', 'Churn') AND canal NOT IN ('Online', 'ND')",
)
def p7(i):
    kept = i.view("planos").where(
        c("status_recorrente").isin("flat", "Churn") & ~c("canal").isin("Online", "ND")
    )
    return kept.select("id_conta_olx", "id_contrato", "competencia")


@check("P8_case_blank_search", GOLD + f" SELECT {ID}, pacote FROM gold WHERE regexp_matches(pacote, '(?i)INSER')")
def p8(i):
    return i.gold.where(T.mentions(c("pacote"), "inser")).select("advertiser_id", "mes_base", "pacote")


@check(
    "P9_null_or_different",
    GOLD + f" SELECT {ID}, dt_cancelado FROM gold WHERE dt_cancelado IS NULL OR dt_cancelado <> mes_base",
)
def p9(i):
    return i.gold.where(grids.KEPT).select("advertiser_id", "mes_base", "dt_cancelado")


@check("P10_this_and_last_month", PAIDS + f" SELECT advertiser_id, mes_pago, status_ts, dt FROM paids WHERE {S.TWO_MONTHS}")
def p10(i):
    kept = i.view("paids").where(c("mes_pago").isin(payments.payment_months(X.AS_OF)))
    return kept.select("advertiser_id", "mes_pago", "status_ts", "dt")


@check(
    "P11_text_not_zero",
    DEALS
    + """ SELECT uniqueopportunityidentifier__c, discountrecurringvalue__c FROM opportunity
 WHERE discountrecurringvalue__c IS NOT NULL AND discountrecurringvalue__c <> '0' AND discountrecurringvalue__c <> '0.0'""",
)
def p11(i):
    v = c("discountrecurringvalue__c")
    kept = i.view("opportunity").where((v != "0") & (v != "0.0"))
    return kept.select("uniqueopportunityidentifier__c", "discountrecurringvalue__c")


@check("P12_date_lower_bound", GOLD + f" SELECT {ID} FROM gold WHERE mes_base >= {S.SINCE}")
def p12(i):
    return i.gold.where(c("mes_base") >= F.lit(X.TRANSFER_SINCE)).select("advertiser_id", "mes_base")


# ---- functions --------------------------------------------------------------------------------


@check(
    "F1_F2_trim_and_upper",
    GOLD
    + f" SELECT {ID}, upper(trim(estado)) AS upper_state, trim(cordenador) AS trimmed, cordenador AS untouched FROM gold",
)
def f1(i):
    return i.gold.select(
        "advertiser_id", "mes_base", T.clean_upper(c("estado")).alias("upper_state"),
        T.strip(c("cordenador")).alias("trimmed"), T.trim_set(c("cordenador"), "").alias("untouched"),
    )


@check(
    "F3_F4_concat_coalesce_nullif",
    GOLD
    + f" SELECT {ID}, advertiser_id || tamanho AS joined, coalesce(nullif(cordenador, ''), canal_conta) AS person FROM gold",
)
def f3(i):
    return i.gold.select(
        "advertiser_id", "mes_base", T.join_key(c("advertiser_id"), c("tamanho")).alias("joined"),
        B.payment_coordinator(c("canal_conta"), c("cordenador")).alias("person"),
    )


@check(
    "F5_F6_F7_digits_and_safe_casts",
    PLANS
    + f""" SELECT id_conta_olx, id_contrato, competencia, nullif(regexp_extract(package_name, '[0-9]+'), '') AS digits,
 {S.number('package_name')} AS number, regexp_matches(package_name, '^Pacote') AS named,
 TRY_CAST(package_name AS DOUBLE) AS as_double, TRY_CAST(package_name AS DATE) AS as_date FROM planos""",
)
def f5(i):
    name = c("package_name")
    return i.view("planos").select(
        "id_conta_olx", "id_contrato", "competencia", T.first_digits(name).alias("digits"),
        T.first_number(name).alias("number"), name.rlike("^Pacote").alias("named"),
        name.try_cast("double").alias("as_double"), name.try_cast("date").alias("as_date"),
    )


@check(
    "F8_casts",
    DEALS
    + """ SELECT uniqueopportunityidentifier__c AS id, CAST(amount AS VARCHAR) AS as_text, CAST(amount AS DOUBLE) AS as_double,
 CAST(CAST(amount AS DECIMAL(38,9)) AS DOUBLE) AS as_numeric, CAST(uniqueopportunityidentifier__c AS INTEGER) AS as_int FROM opportunity""",
)
def f8(i):
    return i.view("opportunity").select(
        c("uniqueopportunityidentifier__c").alias("id"), c("amount").cast("string").alias("as_text"),
        c("amount").cast("double").alias("as_double"), c("amount").cast("decimal(38,9)").alias("as_numeric"),
        c("uniqueopportunityidentifier__c").cast("int").alias("as_int"),
    )


@check(
    "F9_F10_day_month_year_text",
    PAIDS
    + """ SELECT advertiser_id, mes_pago, status_ts, dt, strftime(day_paid, '%d/%m/%Y') AS shown, day_paid AS from_br,
 day_paid AS from_iso, CAST(NULL AS DATE) AS unreadable FROM paids""",
)
def f9(i):
    shown = D.show_date(c("day_paid"))
    return i.view("paids").select(
        "advertiser_id", "mes_pago", "status_ts", "dt", shown.alias("shown"),
        D.read_date(shown).alias("from_br"), D.read_date(c("day_paid")).alias("from_iso"),
        D.read_date(c("status_ts")).alias("unreadable"),
    )


@check(
    "F11_to_F16_date_arithmetic",
    GOLD
    + f""" SELECT {ID}, CAST(day_base + INTERVAL 1 MONTH AS DATE) AS next_month, CAST(day_base - INTERVAL 1 MONTH AS DATE) AS last_month,
 CAST(day_base + INTERVAL 6 DAY AS DATE) AS six_on, CAST(day_base - INTERVAL 6 DAY AS DATE) AS six_back, last_day(day_base) AS month_end,
 CAST(date_trunc('month', day_base) AS DATE) AS month_first, CAST(date_diff('day', DATE '1899-12-30', day_base) AS INTEGER) AS serial,
 CAST(month(day_base) AS INTEGER) AS m, CAST(year(day_base) AS INTEGER) AS y, CAST(day(day_base) AS INTEGER) AS d FROM gold""",
)
def f11(i):
    day = c("day_base")
    return i.gold.select(
        "advertiser_id", "mes_base",
        D.shift_months(day, 1).alias("next_month"), D.shift_months(day, -1).alias("last_month"),
        F.date_add(day, 6).alias("six_on"), F.date_sub(day, 6).alias("six_back"),
        F.last_day(day).alias("month_end"), D.month_start(day).alias("month_first"),
        D.serial_day(day).alias("serial"),
        F.month(day).alias("m"), F.year(day).alias("y"), F.day(day).alias("d"),
    )


@check(
    "F17_F18_weekdays_of_month",
    f"""WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
 d AS (SELECT month, CAST(unnest(generate_series(last_day(month) - INTERVAL 15 DAY, CAST(last_day(month) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM m),
 k AS (SELECT month, day, row_number() OVER (PARTITION BY month ORDER BY day DESC) AS n FROM d WHERE dayofweek(day) NOT IN (0, 6))
 SELECT month, day, CAST(dayofweek(day) + 1 AS INTEGER) AS dow FROM k WHERE n <= 6""",
)
def f17(i):
    months = i.table("orders").select(F.trunc("o_orderdate", "MM").alias("month")).distinct()
    days = months.select("month", F.explode(D.last_weekdays(c("month"), 6)).alias("day"))
    return days.withColumn("dow", F.dayofweek("day"))


@check("F19_as_of_date", f"SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), {S.AS_OF}) AS INTEGER) AS age FROM orders")
def f19(i):
    age = F.datediff(F.lit(X.AS_OF), F.to_date("o_orderdate"))
    return i.table("orders").select("o_orderkey", age.alias("age"))


@check(
    "F20_F21_F22_numbers",
    DEALS
    + """ SELECT uniqueopportunityidentifier__c AS id, CAST(round(amount) AS DOUBLE) AS rounded, CAST(round(-amount) AS DOUBLE) AS rounded_back,
 CAST(-1 * amount AS DOUBLE) AS negative, year * 10000 + month * 100 + day AS stamp, (year * 10000 + month * 100 + day) // 10000 AS y,
 abs(CAST(amount AS DOUBLE) - 150000) < greatest(150000 * 0.05, 1) AS near FROM opportunity""",
)
def f20(i):
    stamp = c("year") * 10000 + c("month") * 100 + c("day")
    gap = F.abs(c("amount").cast("double") - 150000)
    return i.view("opportunity").select(
        c("uniqueopportunityidentifier__c").alias("id"),
        F.round("amount", 0).alias("rounded"), F.round(-c("amount"), 0).alias("rounded_back"),
        (c("amount") * -1).alias("negative"), stamp.alias("stamp"),
        F.floor(stamp / 10000).cast("int").alias("y"), (gap < F.greatest(F.lit(150000 * 0.05), F.lit(1.0))).alias("near"),
    )


# ---- business columns -------------------------------------------------------------------------


def enriched_column(name: str, *columns: str):
    """A business column as it comes out of the enrichment."""
    picked = ("advertiser_id", "mes_base", *columns)

    @check(name, S.enriched(f"SELECT {', '.join(picked)} FROM enr"))
    def build(i):
        return i.enriched().select(*picked)


enriched_column("C1_region", "estado", "municipio", "regionalizacao")
enriched_column("C2_adjusted_size", "pacote", "tamanho_nr", "tamanho_ajustado")
enriched_column("C5_team", "coordenador_ajustado")
enriched_column("C8_migrated", "status_migrado")
enriched_column("C10_previous_channel_and_team", "aux_canal_out", "aux_coord_out")
enriched_column("C11_team_before", "coordenador_ajustado_out")
enriched_column("C12_transfer_from_data", "id_migracao_pro_field")
enriched_column("C14_phased_discount", "desconto_faseado")
enriched_column("C15_paid_marks", "apoio_qtd_campanha", "apoio_qtd_sva")
enriched_column("C16_keys", "id_e_data", "id_ajustado", "chave_churn")


@check(
    "C3_official_size",
    PLANS
    + f""" SELECT id_conta_olx, id_contrato, competencia, {S.band(S.number('package_name'), "'PP'")} AS null_as_pp,
 {S.band(S.number('package_name'))} AS null_as_null FROM planos""",
)
def c3(i):
    return i.view("planos").select(
        "id_conta_olx", "id_contrato", "competencia",
        B.official_size(c("package_name"), "PP").alias("null_as_pp"),
        B.official_size(c("package_name")).alias("null_as_null"),
    )


@check("C4_fold_smallest", PLANS + f" SELECT id_conta_olx, id_contrato, competencia, {S.fold('tamanho')} AS size FROM planos")
def c4(i):
    return i.view("planos").select(
        "id_conta_olx", "id_contrato", "competencia", B.fold_smallest(c("tamanho")).alias("size")
    )


@check(
    "C6_payment_team",
    GOLD
    + f" SELECT {ID}, CASE WHEN canal_conta IN ('Online', 'ND') THEN canal_conta ELSE coalesce(upper(trim(cordenador)), '') END AS team FROM gold",
)
def c6(i):
    return i.gold.select(
        "advertiser_id", "mes_base", B.payment_team(c("canal_conta"), c("cordenador")).alias("team")
    )


@check(
    "C7_team_variants",
    PLANS
    + f""" SELECT id_conta_olx, id_contrato, competencia, {S.team('canal', 'coordenador_conta', '', '')} AS blank,
 {S.team('canal', 'coordenador_conta', 'Online', 'ND')} AS mixed, {S.team('canal', 'coordenador_conta', 'ONLINE', 'ND')} AS upper_case FROM planos""",
)
def c7(i):
    pair = (c("canal"), c("coordenador_conta"))
    return i.view("planos").select(
        "id_conta_olx", "id_contrato", "competencia", B.team(*pair, "", "").alias("blank"),
        B.team(*pair, "Online", "ND").alias("mixed"), B.team(*pair, "ONLINE", "ND").alias("upper_case"),
    )


@check(
    "C9_migrated_from_start",
    GOLD
    + f", {S._HISTORY} SELECT {ID}, CASE WHEN mv THEN 'Migrado' ELSE 'Não' END AS status, CASE WHEN mv THEN pc END AS aux_canal_out, CASE WHEN mv THEN pp END AS aux_coord_out FROM hist",
)
def c9(i):
    rows = payments.account_history(i.gold, unique_months=True)
    status = F.coalesce(c("status_migrado"), F.lit(B.NO))
    return rows.select("advertiser_id", "mes_base", status.alias("status"), "aux_canal_out", "aux_coord_out")


@check(
    "C13_transfer_history",
    GOLD
    + f", {S._HISTORY} SELECT DISTINCT advertiser_id FROM hist WHERE mv AND canal_conta = 'Field' AND mes_base >= {S.SINCE}",
)
def c13(i):
    return payments.moved_to_field(payments.account_history(i.gold, True), X.TRANSFER_SINCE)


def payment_column(name: str, *columns: str, text: str = S.PAYMENTS, **options):
    @check(
        name,
        X.with_views("gold", "paids")
        + f", {text} SELECT advertiser_id, mes_pago, {', '.join(columns)} FROM cb",
    )
    def build(i):
        return i.payments(**options).select("advertiser_id", "mes_pago", *columns)


payment_column("C17_serial_key", "id_e_data", text=S.payments('TRUE'), all_months=True)
payment_column("C22_payment_coordinator", "coordenador", "canal", text=S.payments('TRUE'), all_months=True)


@check(
    "C18_weekday_cutoff",
    """WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
 d AS (SELECT month, CAST(unnest(generate_series(last_day(month) - INTERVAL 15 DAY, CAST(last_day(month) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM m),
 k AS (SELECT month, day, row_number() OVER (PARTITION BY month ORDER BY day DESC) AS n FROM d WHERE dayofweek(day) NOT IN (0, 6))
 SELECT month, min(day) AS cutoff FROM k WHERE n <= 6 GROUP BY month""",
)
def c18(i):
    months = i.table("orders").select(F.trunc("o_orderdate", "MM").alias("month")).distinct()
    return months.select("month", D.weekday_cutoff(c("month"), 6).alias("cutoff"))


@check(
    "C19_elapsed_volume",
    S.enriched(f"SELECT {ID}, data_pagamento_cohort, CAST(volume_transcorrido AS DOUBLE) AS volume_transcorrido FROM enr"),
)
def c19(i):
    return i.enriched().select("advertiser_id", "mes_base", "data_pagamento_cohort", "volume_transcorrido")


@check(
    "C20_delta_class",
    PLANS
    + ", "
    + S.plan_rows("id_conta_olx, id_contrato", "competencia", "", "", "'PP'")
    + " SELECT id_conta_olx, id_contrato, competencia, classifica_up FROM plan",
)
def c20(i):
    rows = recurring.planos_periodicos(i.view("planos"), bounded=True)
    return rows.select("id_conta_olx", "id_contrato", "competencia", "classifica_up")


@check(
    "C21_size_status",
    GOLD
    + """, s AS (SELECT advertiser_id, mes_base, tamanho, LAG(tamanho) OVER (PARTITION BY advertiser_id ORDER BY mes_base) AS before FROM gold)
 SELECT advertiser_id, mes_base, CASE WHEN before IS NULL THEN 'Novo' WHEN before = tamanho THEN 'OK' ELSE 'Mudou' END AS status FROM s""",
)
def c21(i):
    rows = add_previous(
        i.gold.select("advertiser_id", "mes_base", "tamanho"), ["advertiser_id"], ["mes_base"],
        {"before": "tamanho"}, bounded=True,
    )
    return rows.select("advertiser_id", "mes_base", B.size_status(c("tamanho"), c("before")).alias("status"))


@check(
    "C23_payment_amounts",
    X.with_views("gold", "paids")
    + f", {S.payments('TRUE')} SELECT advertiser_id, mes_pago, CAST(pago_mes AS DOUBLE) AS pago_mes, CAST(antecipado + no_mes + transcorrido AS DOUBLE) AS parts FROM cb",
)
def c23(i):
    """All months instead of the last two."""
    parts = c("antecipado") + c("no_mes") + c("transcorrido")
    return i.payments(all_months=True).select("advertiser_id", "mes_pago", "pago_mes", parts.alias("parts"))


@check(
    "C24_payment_region",
    "SELECT r_name, CASE r_name WHEN 'ASIA' THEN 'RJ' WHEN 'AFRICA' THEN 'NE' ELSE r_name END AS region FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def c24(i):
    t = i.table("customer").join(i.table("nation"), c("c_nationkey") == c("n_nationkey"))
    t = t.join(i.table("region"), c("n_regionkey") == c("r_regionkey"))
    coded = F.when(c("r_name") == "ASIA", "RJ+MG+ES").when(c("r_name") == "AFRICA", "N+NE+CO")
    return t.select("r_name", B.payment_region(F.coalesce(coded, c("r_name"))).alias("region"))


@check(
    "C25_cell_keys",
    GOLD
    + f" SELECT {ID}, canal_conta || coalesce(upper(trim(cordenador)), '') AS team_key, canal_conta || cordenador || tamanho AS cross_key FROM gold",
)
def c25(i):
    person = F.coalesce(T.clean_upper(c("cordenador")), F.lit(""))
    return i.gold.select(
        "advertiser_id", "mes_base", T.join_key(c("canal_conta"), person).alias("team_key"),
        T.join_key(c("canal_conta"), c("cordenador"), c("tamanho")).alias("cross_key"),
    )
