"""Checks of joins, aggregates, ordered lookups, sorts and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cascata.functions import dates as D
from cascata.functions import text as T
from cascata.operators.lookups import (
    add_member_flag, distinct_keys, exact_or_latest, keys_of_both, union_all, union_distinct,
)
from cascata.operators.ordered import add_delta, add_previous, first_per, latest_per
from cascata.operators.waterfall import ONE, Metric, Part, Role, Source, Waterfall
from cascata.plans import chain, daily, grids
from cascata.sources import scans
from checks import fixtures as X
from checks import sql_parts as S
from checks import sql_waterfalls as W
from checks.registry import check

c = F.col
GOLD = X.with_views("gold")
PLANS = X.with_views("planos")
PAIDS = X.with_views("paids")
CRM = X.with_views("opportunity", "account", "crm_user")


# ---- joins ------------------------------------------------------------------------------------


@check(
    "J1_left_join_one_key",
    "SELECT o_orderkey, o_custkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def j1(i):
    joined = i.table("orders").join(i.table("customer"), c("o_custkey") == c("c_custkey"), "left")
    return joined.select("o_orderkey", "o_custkey", "c_name")


@check(
    "J2_left_join_cast_key",
    GOLD + " SELECT advertiser_id, mes_base, c_name FROM gold LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = advertiser_id",
)
def j2(i):
    joined = i.gold.join(i.table("customer"), c("c_custkey").cast("string") == c("advertiser_id"), "left")
    return joined.select("advertiser_id", "mes_base", "c_name")


@check(
    "J3_left_join_two_keys_fan_out",
    X.with_views("gold", "paids")
    + " SELECT g.advertiser_id, g.mes_base, p.status_ts, p.dt FROM gold g LEFT JOIN paids p ON g.advertiser_id = p.advertiser_id AND g.mes_base = p.mes_pago",
)
def j3(i):
    paid = i.view("paids").select("advertiser_id", c("mes_pago").alias("mes_base"), "status_ts", c("dt").alias("p_dt"))
    joined = i.gold.drop("status_ts", "dt").join(paid, ["advertiser_id", "mes_base"], "left")
    return joined.select("advertiser_id", "mes_base", "status_ts", c("p_dt").alias("dt"))


CELL = "canal_conta, coordenador_ajustado, regionalizacao, mes_base, sz, tr"
NAMED = "canal_conta AS Canal, coordenador_ajustado AS Equipe, regionalizacao AS Regiao_Macro, mes_base AS Mes_Base, sz AS Tamanho, tr AS Transferencias"


def _cell_counts(frame, dims, keys, terms):
    """A small waterfall: the join of a grid with several metrics, as one grouping."""
    roles = {name: Role(dict(zip(dims, cols)), grid) for name, (cols, grid) in keys.items()}
    metrics = [Metric(n, (Part("rows", role, where, value),)) for n, role, where, value in terms]
    group = ["canal_conta", "coordenador_ajustado", "reg", "mes_base", "tam", "transf", "out_canal", "out_equipe"]
    return Waterfall(list(dims), metrics, {"rows": Source(frame, roles, group)}).build()


@check(
    "J4_grid_join_six_keys",
    S.enriched(
        f"""SELECT g.*, coalesce(n.v, 0) AS novos_qtd, CAST(coalesce(u.v, 0) AS DOUBLE) AS up_valor FROM (SELECT DISTINCT {NAMED} FROM r) g
 LEFT JOIN (SELECT {NAMED}, count(*) AS v FROM r WHERE classificacao = 'Novo' GROUP BY ALL) n USING (Canal, Equipe, Regiao_Macro, Mes_Base, Tamanho, Transferencias)
 LEFT JOIN (SELECT {NAMED}, sum(delta) AS v FROM r WHERE classificacao = 'Upgrade' GROUP BY ALL) u USING (Canal, Equipe, Regiao_Macro, Mes_Base, Tamanho, Transferencias)""",
        W.ROWS,
    ),
)
def j4(i):
    dims = [*grids.DIMS, grids.FLAG]
    here = ("canal_conta", "coordenador_ajustado", "reg", "mes_base", "tam", "transf")
    return _cell_counts(
        grids.revenue_rows(i.enriched()), dims, {"CUR": (here, "TRUE")},
        [
            ("novos_qtd", "CUR", grids.NEW, ONE),
            ("up_valor", "CUR", grids.UP, grids.DELTA),
        ],
    )


@check(
    "J5_grid_join_five_keys",
    S.enriched(
        f"""SELECT g.*, coalesce(o.v, 0) AS saidas FROM (SELECT DISTINCT {NAMED} FROM r) g
 LEFT JOIN (SELECT aux_canal_out AS Canal, coordenador_ajustado_out AS Equipe, regionalizacao AS Regiao_Macro, mes_base AS Mes_Base,
 sz AS Tamanho, count(*) AS v FROM r WHERE status_migrado = 'Migrado' GROUP BY ALL) o USING (Canal, Equipe, Regiao_Macro, Mes_Base, Tamanho)""",
        W.ROWS,
    ),
)
def j5(i):
    """The metric has no transfer key, so both flags of a cell get it."""
    dims = [*grids.DIMS, grids.FLAG]
    here = ("canal_conta", "coordenador_ajustado", "reg", "mes_base", "tam", "transf")
    left = ("out_canal", "out_equipe", "reg", "mes_base", "tam")
    roles = {"CUR": (here, "TRUE")}
    for flag in ("Sim", "Não"):
        roles[flag] = ((*left, f"'{flag}'"), None)
    frame = grids.revenue_rows(i.enriched())
    cells = _cell_counts(
        frame, dims, roles,
        [("s_sim", "Sim", grids.MOVED, ONE), ("s_nao", "Não", grids.MOVED, ONE)],
    )
    return cells.withColumn("saidas", c("s_sim") + c("s_nao")).drop("s_sim", "s_nao")


@check(
    "J6_J7_J8_snapshot_joins",
    CRM
    + """, n AS (SELECT max(year * 10000 + month * 100 + day) AS m FROM opportunity WHERE year >= 2000)
 SELECT o.uniqueopportunityidentifier__c AS deal, a.name AS account, u.name AS owner FROM opportunity o CROSS JOIN n
 JOIN account a ON o.accountid = a.id AND a.year = m // 10000 AND a.month = (m % 10000) // 100 AND a.day = m % 100
 LEFT JOIN crm_user u ON o.ownerid = u.id AND u.year = m // 10000 AND u.month = (m % 10000) // 100 AND u.day = m % 100
 WHERE o.year = m // 10000 AND o.month = (m % 10000) // 100 AND o.day = m % 100""",
)
def j6(i):
    """Inner and left join against one snapshot; the one-row relation is a scalar subquery."""
    deals = i.view("opportunity")
    newest = scans.newest_day_number(deals, X.AS_OF)
    at = lambda name: scans.at_day_number(i.view(name), newest)
    accounts = at("account").select(c("id").alias("a_id"), c("name").alias("account"))
    users = at("crm_user").select(c("id").alias("u_id"), c("name").alias("owner"))
    joined = scans.at_day_number(deals, newest).join(accounts, c("accountid") == c("a_id"))
    joined = joined.join(users, c("ownerid") == c("u_id"), "left")
    return joined.select(c("uniqueopportunityidentifier__c").alias("deal"), "account", "owner")


EXACT_OR_LATEST = """, h AS (SELECT *, row_number() OVER (PARTITION BY advertiser_id ORDER BY mes_base DESC NULLS LAST) AS k FROM gold),
 x AS (SELECT p.advertiser_id, p.mes_pago, p.status_ts, p.dt, h.canal_conta, h.estado, row_number() OVER (PARTITION BY p.advertiser_id, p.mes_pago, p.status_ts, p.dt
 ORDER BY CASE WHEN h.mes_base = p.mes_pago THEN 1 ELSE 2 END, h.mes_base DESC NULLS LAST) AS r FROM paids p
 LEFT JOIN h ON h.advertiser_id = p.advertiser_id AND (h.mes_base = p.mes_pago OR h.k = 1))
 SELECT advertiser_id, mes_pago, status_ts, dt, canal_conta, estado FROM x WHERE r = 1"""


def _with_history(i):
    history = i.gold.select("advertiser_id", "mes_base", "canal_conta", "estado")
    paid = i.view("paids").select("advertiser_id", "mes_pago", "status_ts", "dt")
    return exact_or_latest(paid, history, "advertiser_id", "mes_pago", "mes_base")


@check("J9_exact_or_latest_join", X.with_views("gold", "paids") + EXACT_OR_LATEST)
def j9(i):
    return _with_history(i)


@check(
    "J10_either_date_join",
    GOLD
    + """, d AS (SELECT day_base AS dia FROM gold UNION SELECT day_churn FROM gold WHERE day_churn IS NOT NULL),
 hit AS (SELECT d.dia, g.advertiser_id, g.mes_base FROM d JOIN gold g ON g.day_base = d.dia UNION
 SELECT d.dia, g.advertiser_id, g.mes_base FROM d JOIN gold g ON g.day_churn = d.dia)
 SELECT dia, count(*) AS n FROM hit GROUP BY dia""",
)
def j10(i):
    """OR join on two dates as one row per distinct date of the row."""
    days = F.array_distinct(F.array_compact(F.array("day_base", "day_churn")))
    return i.gold.select(F.explode(days).alias("dia")).groupBy("dia").agg(F.count("*").alias("n"))


@check(
    "J11_semi_join",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def j11(i):
    some = i.table("orders").where("o_orderstatus = 'P'")
    return i.table("customer").join(some, c("c_custkey") == c("o_custkey"), "left_semi").select("c_custkey", "c_name")


@check(
    "J12_existence_flag",
    X.with_views("gold")
    + """ SELECT advertiser_id, mes_base, CASE WHEN canal_conta = 'Field' AND advertiser_id IN
 (SELECT advertiser_id FROM gold WHERE canal_conta = 'ND') THEN 'Sim' ELSE 'Não' END AS flag FROM gold""",
)
def j12(i):
    rows = i.gold.select("advertiser_id", "mes_base", "canal_conta")
    flagged = add_member_flag(rows, "advertiser_id", i.gold.where("canal_conta = 'ND'"), "in_nd")
    flag = F.when((c("canal_conta") == "Field") & c("in_nd"), "Sim").otherwise("Não")
    return flagged.select("advertiser_id", "mes_base", flag.alias("flag"))


@check(
    "J13_scalar_subquery",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)",
)
def j13(i):
    t = i.table("orders")
    return t.where(c("o_totalprice") == t.select(F.max("o_totalprice")).scalar()).select("o_orderkey", "o_totalprice")


@check(
    "J14_conditional_sums_per_outer_row",
    GOLD
    + """ SELECT d.canal_conta, d.mes_base, (SELECT count(*) FROM gold g WHERE g.canal_conta = d.canal_conta AND g.mes_base = d.mes_base - INTERVAL 1 MONTH
 AND (g.dt_cancelado IS NULL OR g.dt_cancelado <> g.mes_base)) AS base, CAST((SELECT coalesce(sum(delta), 0) FROM gold g
 WHERE g.canal_conta = d.canal_conta AND g.mes_base = d.mes_base AND g.classificacao = 'Upgrade') AS DOUBLE) AS up FROM (SELECT DISTINCT canal_conta, mes_base FROM gold) d""",
)
def j14(i):
    dims = ("canal_conta", "mes_base")
    roles = {
        "CUR": Role({"canal_conta": "canal_conta", "mes_base": "mes_base"}, "TRUE"),
        "NEXT": Role({"canal_conta": "canal_conta", "mes_base": "add_months(mes_base, 1)"}),
    }
    metrics = [
        Metric("base", (Part("gold", "NEXT", grids.KEPT),)),
        Metric("up", (Part("gold", "CUR", grids.UP, grids.DELTA),)),
    ]
    return Waterfall(dims, metrics, {"gold": Source(i.gold, roles, list(dims))}).build()


@check(
    "J15_A13_min_of_last_weekdays",
    """WITH m AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
 u AS (SELECT DISTINCT month FROM m), d AS (SELECT month, CAST(unnest(generate_series(last_day(month) - INTERVAL 15 DAY, CAST(last_day(month) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM u),
 k AS (SELECT month, day, row_number() OVER (PARTITION BY month ORDER BY day DESC) AS n FROM d WHERE dayofweek(day) NOT IN (0, 6)),
 f AS (SELECT month, min(day) AS first_of_six FROM k WHERE n <= 6 GROUP BY month)
 SELECT o_orderkey, first_of_six FROM m JOIN f USING (month)""",
)
def j15(i):
    month = F.trunc("o_orderdate", "MM")
    return i.table("orders").select("o_orderkey", F.array_min(D.last_weekdays(month, 6)).alias("first_of_six"))


@check(
    "J16_now_and_ever_elsewhere",
    GOLD
    + """ SELECT DISTINCT advertiser_id FROM gold WHERE canal_conta = 'Field' AND classificacao <> 'Novo' AND advertiser_id IN
 (SELECT advertiser_id FROM gold WHERE canal_conta <> 'Field')""",
)
def j16(i):
    now = (c("canal_conta") == "Field") & (c("classificacao") != "Novo")
    return keys_of_both(i.gold, "advertiser_id", now, c("canal_conta") != "Field")


@check(
    "J17_exact_else_latest_counts",
    X.with_views("gold", "paids")
    + ", y AS ("
    + EXACT_OR_LATEST.replace(", h AS", "WITH h AS", 1)
    + ") SELECT canal_conta, estado, count(*) AS n FROM y GROUP BY ALL",
)
def j17(i):
    return _with_history(i).groupBy("canal_conta", "estado").agg(F.count("*").alias("n"))


# ---- aggregates -------------------------------------------------------------------------------

BY = "canal_conta, mes_base"


def by_cell(i, *sums):
    return i.gold.groupBy("canal_conta", "mes_base").agg(*sums)


@check(
    "A1_A4_A6_A7_conditional_aggregates",
    GOLD
    + f""" SELECT {BY}, count(*) FILTER (classificacao = 'Novo') AS novos, CAST(coalesce(sum(faturado_mes) FILTER (status_ts = '1-Paid'), 0) AS DOUBLE) AS paid,
 CAST(sum(CASE WHEN delta > 0 THEN delta ELSE 0 END) AS DOUBLE) AS ups, count(*) FILTER (pago_mes_campanha <> 0) AS campaigns FROM gold GROUP BY ALL""",
)
def a1(i):
    paid = F.coalesce(F.sum(F.when(c("status_ts") == "1-Paid", c("faturado_mes"))), F.lit(0))
    return by_cell(
        i,
        F.count_if(c("classificacao") == "Novo").alias("novos"),
        paid.alias("paid"),
        F.sum(F.when(c("delta") > 0, c("delta")).otherwise(0)).alias("ups"),
        F.count_if(c("pago_mes_campanha") != 0).alias("campaigns"),
    )


@check(
    "A2_distinct_under_conditions",
    S.enriched(
        """SELECT canal_conta AS Canal, coordenador_ajustado AS Equipe, count(DISTINCT CASE WHEN classificacao = 'Novo' THEN advertiser_id END) AS novos,
 count(DISTINCT CASE WHEN status_migrado = 'Migrado' THEN advertiser_id END) AS migrados FROM enr GROUP BY ALL"""
    ),
)
def a2(i):
    dims = ("Canal", "Equipe")
    key = {"Canal": "canal_conta", "Equipe": "coordenador_ajustado"}
    parts = [("novos", grids.NEW), ("migrados", grids.MOVED)]
    metrics = [Metric(n, (Part("rows", "CUR", where, distinct=True),)) for n, where in parts]
    source = Source(
        i.enriched(), {"CUR": Role(key, "TRUE")},
        ["canal_conta", "coordenador_ajustado"], id="advertiser_id",
    )
    return Waterfall(dims, metrics, {"rows": source}).build()


@check(
    "A3_distinct_joined_ids",
    PLANS
    + " SELECT canal, count(DISTINCT CAST(id_conta_olx AS VARCHAR) || CAST(id_contrato AS VARCHAR)) AS n FROM planos GROUP BY canal",
)
def a3(i):
    ids = i.view("planos").select("canal", T.join_key(c("id_conta_olx"), c("id_contrato")).alias("id")).distinct()
    return ids.groupBy("canal").agg(F.count("id").alias("n"))


@check(
    "A5_A8_sums_of_coalesced_and_cast",
    GOLD
    + f""" SELECT {BY}, CAST(sum(coalesce(faturado_mes_bairro_vip, 0) + coalesce(faturado_mes_topo_fixo, 0)) AS DOUBLE) AS addons,
 sum(TRY_CAST(regexp_extract(pacote, '[0-9]+') AS BIGINT))::BIGINT AS sizes FROM gold GROUP BY ALL""",
)
def a5(i):
    return by_cell(
        i,
        F.expr("sum(" + grids._sum_of("faturado_mes_bairro_vip", "faturado_mes_topo_fixo") + ")").alias("addons"),
        F.sum(T.first_number(c("pacote"))).alias("sizes"),
    )


@check(
    "A9_A10_group_by_expressions",
    GOLD
    + """ SELECT canal_conta, CAST(mes_base + INTERVAL 1 MONTH AS DATE) AS mes_ref, coalesce(tamanho, '') AS t, count(*) AS qtd,
 CAST(sum(faturado_mes) AS DOUBLE) AS val FROM gold GROUP BY ALL""",
)
def a9(i):
    keys = ("canal_conta", D.shift_months(c("mes_base"), 1).alias("mes_ref"), F.coalesce("tamanho", F.lit("")).alias("t"))
    return i.gold.groupBy(*keys).agg(F.count("*").alias("qtd"), F.sum("faturado_mes").alias("val"))


@check("A11_distinct", GOLD + " SELECT DISTINCT canal_conta, cordenador, estado FROM gold")
def a11(i):
    return distinct_keys(i.gold, "canal_conta", "cordenador", "estado")


@check("A12_global_max_and_count", PAIDS + " SELECT max(dt) AS newest, count(*) AS n FROM paids")
def a12(i):
    return i.view("paids").agg(F.max("dt").alias("newest"), F.count("*").alias("n"))


@check(
    "A14_pivot",
    S.enriched(
        "SELECT day_base AS dia, "
        + ", ".join(
            f"CAST(round(coalesce(sum(faturado_mes) FILTER (classificacao = 'Novo' AND canal_conta = '{v}'), 0)) AS DOUBLE) AS novo_{v.lower()}"
            for v in daily.CHANNELS
        )
        + " FROM enr WHERE day_base IS NOT NULL GROUP BY day_base"
    ),
)
def a14(i):
    from cascata.operators.pivot import dated_pivot

    return dated_pivot(i.enriched(), daily.CLASSES[:1], "canal_conta", daily.CHANNELS, "dia")


@check(
    "A15_rounded_month_totals",
    GOLD
    + " SELECT mes_base, CAST(round(sum(faturado_mes), 2) AS DOUBLE) AS total, CAST(round(sum(coalesce(pago_mes_topo, 0)), 2) AS DOUBLE) AS topo FROM gold GROUP BY mes_base",
)
def a15(i):
    topo = F.round(F.sum(F.coalesce("pago_mes_topo", F.lit(0))), 2)
    return i.gold.groupBy("mes_base").agg(F.round(F.sum("faturado_mes"), 2).alias("total"), topo.alias("topo"))


@check("A16_distinct_accounts", GOLD + " SELECT DISTINCT advertiser_id FROM gold WHERE advertiser_id IS NOT NULL")
def a16(i):
    return distinct_keys(i.gold.where(c("advertiser_id").isNotNull()), "advertiser_id")


# ---- ordered lookups --------------------------------------------------------------------------

LAG = "LAG({v}{d}) OVER (PARTITION BY advertiser_id ORDER BY mes_base NULLS FIRST)"


@check(
    "W1_previous_values",
    GOLD
    + f" SELECT advertiser_id, mes_base, {LAG.format(v='canal_conta', d='')} AS channel, {LAG.format(v='cordenador', d='')} AS person FROM gold",
)
def w1(i):
    """General form: accounts with many rows would be split."""
    rows = add_previous(
        i.gold, ["advertiser_id"], ["mes_base"], {"channel": "canal_conta", "person": "cordenador"}
    )
    return rows.select("advertiser_id", "mes_base", "channel", "person")


@check(
    "W1_previous_values_all_keys_split",
    GOLD
    + f" SELECT advertiser_id, mes_base, {LAG.format(v='canal_conta', d='')} AS channel FROM gold",
)
def w1_split(i):
    """Every account of more than two rows is cut, to exercise the split on real data."""
    rows = add_previous(
        i.gold.select("advertiser_id", "mes_base", "canal_conta"), ["advertiser_id"], ["mes_base"],
        {"channel": "canal_conta"}, hot_rows=2,
    )
    return rows.select("advertiser_id", "mes_base", "channel")


DEFAULTED = LAG.format(v="canal_conta", d=", 1, 'inicio'")


@check("W2_previous_with_default", GOLD + f" SELECT advertiser_id, mes_base, {DEFAULTED} AS channel FROM gold")
def w2(i):
    rows = add_previous(i.gold, ["advertiser_id"], ["mes_base"], {"channel": "canal_conta"}, "inicio")
    return rows.select("advertiser_id", "mes_base", "channel")


@check(
    "W3_latest_row",
    GOLD
    + """, k AS (SELECT *, row_number() OVER (PARTITION BY advertiser_id ORDER BY mes_base DESC NULLS LAST) AS n FROM gold)
 SELECT advertiser_id, mes_base, canal_conta, estado FROM k WHERE n = 1""",
)
def w3(i):
    return latest_per(
        i.gold.select("advertiser_id", "mes_base", "canal_conta", "estado"), ["advertiser_id"], c("mes_base")
    )


@check(
    "W4_one_row_by_rank",
    PAIDS
    + """, k AS (SELECT *, row_number() OVER (PARTITION BY advertiser_id, mes_pago ORDER BY CASE WHEN dt = DATE '2001-08-01' THEN 1 ELSE 2 END,
 status_ts NULLS FIRST, dt) AS n FROM paids) SELECT advertiser_id, mes_pago, status_ts, dt FROM k WHERE n = 1""",
)
def w4(i):
    rank = F.when(c("dt") == F.lit("2001-08-01").cast("date"), 1).otherwise(2)
    rows = i.view("paids").select("advertiser_id", "mes_pago", "status_ts", "dt")
    return first_per(rows, ["advertiser_id", "mes_pago"], rank)


@check(
    "W5_change_per_contract",
    PLANS
    + """ SELECT id_conta_olx, id_contrato, competencia, dt, CAST(valor_mensal - LAG(valor_mensal) OVER
 (PARTITION BY id_conta_olx, id_contrato ORDER BY competencia NULLS FIRST, dt) AS DOUBLE) AS delta FROM planos""",
)
def w5(i):
    rows = i.view("planos").select("id_conta_olx", "id_contrato", "competencia", "dt", "valor_mensal")
    out = add_delta(rows, ["id_conta_olx", "id_contrato"], ["competencia", "dt"], "valor_mensal")
    return out.drop("valor_mensal")


@check(
    "W6_change_per_account",
    PLANS
    + """ SELECT id_conta_olx, id_contrato, competencia, CAST(valor_mensal - LAG(valor_mensal) OVER
 (PARTITION BY id_conta_olx ORDER BY competencia NULLS FIRST, id_contrato NULLS FIRST) AS DOUBLE) AS delta FROM planos""",
)
def w6(i):
    """Accounts above 50 rows are cut by month and contract range."""
    rows = i.view("planos").select("id_conta_olx", "id_contrato", "competencia", "valor_mensal")
    out = add_delta(rows, ["id_conta_olx"], ["competencia", "id_contrato"], "valor_mensal", hot_rows=50)
    return out.drop("valor_mensal")


# ---- sorts and unions -------------------------------------------------------------------------


@check("O1_display_order", GOLD + " SELECT mes_base, canal_conta, count(*) AS n FROM gold GROUP BY ALL ORDER BY mes_base DESC NULLS LAST, canal_conta")
def o1(i):
    grouped = i.gold.groupBy("mes_base", "canal_conta").agg(F.count("*").alias("n"))
    return chain.display(grouped, ("-mes_base", "canal_conta"))


@check(
    "O2_order_by_parsed_date",
    PAIDS + " SELECT strftime(mes_pago, '%d/%m/%Y') AS mes_pago, count(*) AS n FROM paids GROUP BY 1",
)
def o2(i):
    grouped = i.view("paids").groupBy(D.show_date(c("mes_pago")).alias("mes_pago")).agg(F.count("*").alias("n"))
    return chain.display(grouped, ("-mes_pago",))


@check(
    "O3_newest_six_of_list",
    """WITH m AS (SELECT o_custkey, list(DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) ORDER BY CAST(date_trunc('month', o_orderdate) AS DATE) DESC)[1:6] AS months FROM orders GROUP BY 1)
 SELECT o_custkey, list_min(months) AS sixth, CAST(len(months) AS INTEGER) AS n FROM m""",
)
def o3(i):
    """At most one entry per month reaches the list, so its length is bounded by the calendar."""
    months = i.table("orders").select("o_custkey", F.trunc("o_orderdate", "MM").alias("m")).distinct()
    top = F.slice(F.sort_array(F.collect_list("m"), asc=False), 1, 6)
    lists = months.groupBy("o_custkey").agg(top.alias("months"))
    return lists.select("o_custkey", F.array_min("months").alias("sixth"), F.size("months").alias("n"))


@check(
    "U1_union_all",
    X.with_views("gold", "silver_cb")
    + " SELECT advertiser_id, mes_base, canal_conta FROM gold UNION ALL SELECT advertiser_id, mes_base, canal_conta FROM silver_cb",
)
def u1(i):
    picked = ("advertiser_id", "mes_base", "canal_conta")
    return union_all([i.gold.select(*picked), i.view("silver_cb").select(*picked)])


@check(
    "U2_union_distinct_two",
    GOLD + " SELECT day_base AS dia FROM gold WHERE day_base IS NOT NULL UNION SELECT day_churn FROM gold WHERE day_churn IS NOT NULL",
)
def u2(i):
    days = [i.gold.select(c(n).alias("dia")).where("dia IS NOT NULL") for n in ("day_base", "day_churn")]
    return union_distinct(*days)


@check("U3_union_distinct_six", W.grid("full2"))
def u3(i):
    """The wide grid as six plain branches."""
    r, p = grids.revenue_rows(i.enriched()), grids.plan_rows(i.view("planos"))
    dims = [*grids.DIMS, grids.FLAG]

    def cells(frame, *columns):
        return frame.select(*[F.expr(x).alias(d) if isinstance(x, str) else x.alias(d) for x, d in zip(columns, dims)])

    sold, planned = r.where(T.is_filled(c("canal_conta"))), p.where(T.is_filled(c("canal")))
    here = ("canal_conta", "coordenador_ajustado", "reg")
    plan = ("canal", "equipe", "reg")
    return union_distinct(
        cells(sold, *here, "mes_base", "tam", "transf"),
        cells(sold, *here, D.shift_months(c("mes_base"), 1), "tam", "transf"),
        cells(sold.where("dt_cancelado IS NOT NULL"), *here, "dt_cancelado", "tam", "transf"),
        cells(planned, *plan, "competencia", "tam", F.lit("Não")),
        cells(planned, *plan, D.shift_months(c("competencia"), 1), "tam", F.lit("Não")),
        cells(r.where("status_migrado = 'Migrado'"), "out_canal", "out_equipe", "reg", "mes_base", "tam", "transf"),
    )


# ---- metric dictionary ------------------------------------------------------------------------


def metric_totals(name: str, version: str, build):
    """All metrics of a waterfall summed per month: one row per month and metric."""
    names = [m.name for m in grids.metrics(version)]
    types = {n: "DOUBLE" if n.endswith("_valor") else "BIGINT" for n in names}
    sums = ", ".join(f"CAST(sum({n}) AS {t}) AS {n}" for n, t in types.items())
    head = W.waterfall(version).rsplit("\nSELECT ", 1)[0]

    @check(name, f"{head} SELECT Mes_Base, {sums} FROM done GROUP BY Mes_Base")
    def totals(i):
        return build(i).groupBy("Mes_Base").agg(*[F.sum(n).alias(n) for n in names])


metric_totals("M1_to_M34_by_state", grids.UF, lambda i: grids.bd_planos_uf(i.stored_enriched(), i.payments()))
metric_totals(
    "M1_to_M50_without_state", grids.SVA,
    lambda i: grids.bd_planos_mensais_sva(i.stored_enriched(), i.payments()),
)


def _full(build):
    return lambda i: build(i.enriched(), i.payments(), i.kept("planos"))


metric_totals("M1_to_M56_full", grids.FULL, _full(grids.bd_full))
metric_totals("M1_to_M56_full_v2", grids.FULL2, _full(grids.bd_full_v2))


@check(
    "M11_M57_to_M60_closing",
    W.waterfall("full2").rsplit("\nSELECT ", 1)[0]
    + """ SELECT Canal, Equipe, Regiao_Macro, Mes_Base, Tamanho, Transferencias, CAST(base_final_valor AS DOUBLE) AS base_final_valor,
 CAST(base_final_qtd AS BIGINT) AS base_final_qtd, CAST(base_final_pago_valor AS DOUBLE) AS base_final_pago_valor,
 CAST(cancelamento_total_valor AS DOUBLE) AS cancelamento_total_valor, CAST(cancelamento_total_pago_valor AS DOUBLE) AS cancelamento_total_pago_valor FROM done""",
)
def closing(i):
    cells = _full(grids.bd_full_v2)(i)
    return cells.select(
        *grids.DIMS, grids.FLAG, "base_final_valor", "base_final_qtd", "base_final_pago_valor",
        "cancelamento_total_valor", "cancelamento_total_pago_valor",
    )
