"""Checks of the derived tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cascata.plans import crm, daily, grids, recurring, refresh, revenue
from cascata.sources import sinks, versions
from checks import fixtures as X
from checks import sql_parts as S
from checks import sql_waterfalls as W
from checks.registry import ORACLE, check

CB_MONEY = ("antecipado", "no_mes", "transcorrido", "pago_mes")


@check(
    "T1_receita_consolidada",
    X.with_views("gold", "silver_cb")
    + """ SELECT dt, 'receita_unificada' AS fonte, advertiser_id, mes_base, canal_conta, cordenador, estado, tamanho,
 classificacao, CAST(faturado_mes AS DOUBLE) AS faturado_mes, status_ts FROM gold
 UNION ALL SELECT dt, 'receita_cb', advertiser_id, mes_base, canal_conta, dono_conta, estado, tamanho,
 classificacao, CAST(pago_mes AS DOUBLE), status_ts FROM silver_cb""",
)
def t1(i):
    return revenue.receita_consolidada(i.gold, i.view("silver_cb"))


@check(
    "T2_cb_pagamentos",
    X.with_views("gold", "paids") + f", {S.PAYMENTS} SELECT {S.doubles(*CB_MONEY)} FROM cb",
)
def t2(i):
    return i.payments()


@check("T3_receita_enriquecida", S.enriched(f"SELECT {S.doubles(*S.MONEY)} FROM enr"))
def t3(i):
    return i.enriched()


@check("T4_bd_planos_uf", W.waterfall("uf"))
def t4(i):
    return grids.bd_planos_uf(i.stored_enriched(), i.payments())


@check("T5_bd_planos_mensais_sva", W.waterfall("sva"))
def t5(i):
    return grids.bd_planos_mensais_sva(i.stored_enriched(), i.payments())


@check(
    "T6_planos_periodicos",
    X.with_views("planos")
    + ", "
    + S.plan_rows("id_conta_olx, id_contrato", "competencia", "", "", "'PP'")
    + f" SELECT {S.doubles('valor_mensal', 'delta')} FROM plan",
)
def t6(i):
    return recurring.planos_periodicos(i.kept("planos"), bounded=True)


@check("T7_bd_planos_periodicos", W.plan_waterfall())
def t7(i):
    return recurring.bd_planos_periodicos(i.kept("planos"), bounded=True)


@check("T8_bd_full", W.waterfall("full"))
def t8(i):
    return grids.bd_full(i.enriched(), i.payments(), i.kept("planos"))


@check("T9_bd_full_v2", W.waterfall("full2"))
def t9(i):
    return grids.bd_full_v2(i.enriched(), i.payments(), i.kept("planos"))


def _daily_sql() -> str:
    sums = []
    for name, date, column, label, value in (
        ("novo", "day_base", "classificacao", "Novo", "faturado_mes"),
        ("churn", "day_churn", "classificacao_churn", "CHURN", "faturado_mes"),
        ("upgrade", "day_base", "classificacao", "Upgrade", "delta"),
        ("downgrade", "day_base", "classificacao", "Downgrade", "delta"),
    ):
        for channel in ("Field", "Inside", "Online", "ND"):
            sums.append(
                f"CAST(round(coalesce(sum(CASE WHEN {date} = dia AND {column} = '{label}' AND canal_conta = '{channel}' "
                f"THEN {value} END), 0), 0) AS DOUBLE) AS {name}_{channel.lower()}"
            )
    days = "days AS (SELECT day_base AS dia FROM enr WHERE day_base IS NOT NULL UNION SELECT day_churn FROM enr WHERE day_churn IS NOT NULL)"
    pairs = (
        "hits AS (SELECT dia, enr.* FROM days JOIN enr ON day_base = dia UNION ALL "
        "SELECT dia, enr.* FROM days JOIN enr ON day_churn = dia AND day_base IS DISTINCT FROM day_churn)"
    )
    return S.enriched(
        f"SELECT dia AS Mes, {', '.join(sums)}, CAST(day(dia) AS INTEGER) AS dia_numero FROM hits GROUP BY dia",
        f"{days}, {pairs}",
    )


@check("T10_diarizacao", _daily_sql())
def t10(i):
    return daily.diarizacao(i.enriched())


@check(
    "T11_transferencias",
    S.enriched(
        "SELECT advertiser_id, mes_base, tamanho_ajustado AS tamanho, canal_conta, status_migrado, aux_canal_out "
        "FROM enr WHERE status_migrado = 'Migrado' AND canal_conta = 'Field'"
    ),
)
def t11(i):
    return revenue.transferencias(i.enriched())


@check(
    "T12_tamanhos_ajustados",
    S.enriched(
        "SELECT *, CASE WHEN tamanho_atual = tamanho_mes_anterior THEN 'OK' ELSE 'Mudou' END AS status_tamanho, "
        "tamanho_atual AS tamanho_correto_sugerido FROM sizes WHERE tamanho_mes_anterior IS NOT NULL",
        "sizes AS (SELECT advertiser_id, mes_base, tamanho_ajustado AS tamanho_atual, LAG(tamanho_ajustado) "
        "OVER (PARTITION BY advertiser_id ORDER BY mes_base) AS tamanho_mes_anterior FROM enr)",
    ),
)
def t12(i):
    return revenue.tamanhos_ajustados(i.enriched(), unique_months=True)


@check(
    "T13_desconto_faseado",
    X.with_views("gold", "opportunity", "account", "crm_user")
    + f", {S.DISCOUNT} SELECT * FROM discount",
)
def t13(i):
    return i.discounts()


@check("T14_radar_cohort", X.with_views("radar") + f", {S.COHORT} SELECT * FROM cohort")
def t14(i):
    return crm.radar_cohort(i.view("radar"))


@check("T15_grid_uf", W.grid("uf"))
def t15_uf(i):
    return grids.grid(grids.UF, i.enriched())


@check("T15_grid_sva", W.grid("sva"))
def t15_sva(i):
    return grids.grid(grids.SVA, i.enriched())


@check("T15_grid_full", W.grid("full"))
def t15_full(i):
    return grids.grid(grids.FULL, i.enriched(), i.view("planos"))


@check("T15_grid_full_v2", W.grid("full2"))
def t15_full_v2(i):
    return grids.grid(grids.FULL2, i.enriched(), i.view("planos"))


@check(
    "T15_grid_periodicos",
    X.with_views("planos")
    + ", "
    + S.plan_rows("id_conta_olx", "competencia, id_contrato", "Online", "ND", "NULL")
    + """ SELECT DISTINCT canal AS Canal, equipe_ajustada AS Equipe, regionalizacao AS Regiao_Macro, competencia AS Mes_Base,
 tamanho AS Tamanho FROM plan WHERE canal <> '' AND competencia IS NOT NULL AND regionalizacao <> '' AND tamanho <> ''""",
)
def t15_plans(i):
    return recurring.bd_planos_periodicos(i.view("planos"), bounded=True, metrics=False)


# The same tables as the chain builds them, without the statement that months are unique.
@check("T2_cb_pagamentos_default", ORACLE["T2_cb_pagamentos"])
def t2_default(i):
    return i.payments(unique_months=False)


@check("T3_receita_enriquecida_default", ORACLE["T3_receita_enriquecida"])
def t3_default(i):
    return i.enriched(unique_months=False)


@check("T6_planos_periodicos_default", ORACLE["T6_planos_periodicos"])
def t6_default(i):
    return recurring.planos_periodicos(i.kept("planos"), at_rest=True)


@check("T7_bd_planos_periodicos_default", ORACLE["T7_bd_planos_periodicos"])
def t7_default(i):
    return recurring.bd_planos_periodicos(i.kept("planos"), at_rest=True)


@check("T12_tamanhos_ajustados_default", ORACLE["T12_tamanhos_ajustados"])
def t12_default(i):
    return revenue.tamanhos_ajustados(i.enriched(unique_months=False))


# The four waterfalls from the stored sums and ids of one cube; merged from two parts by account.
def _cube(i):
    rows = i.stored_enriched()
    even = F.pmod(F.xxhash64("advertiser_id"), F.lit(2)) == 0
    cubes = [
        grids.cube_of(*[sinks.stored(make(rows.where(part))) for make in (grids.revenue_sums, grids.revenue_ids)])
        for part in (even, ~even)
    ]
    return cubes[0].merge(cubes[1])


@check("T4_bd_planos_uf_cube", ORACLE["T4_bd_planos_uf"])
def t4_cube(i):
    cube = _cube(i)
    return grids.bd_planos_uf(None, i.payments(), cube=cube)


@check("T5_bd_planos_mensais_sva_cube", ORACLE["T5_bd_planos_mensais_sva"])
def t5_cube(i):
    cube = _cube(i)
    return grids.bd_planos_mensais_sva(None, i.payments(), cube=cube)


@check("T8_bd_full_cube", ORACLE["T8_bd_full"])
def t8_cube(i):
    cube = _cube(i)
    return grids.bd_full(None, i.payments(), i.kept("planos"), cube=cube)


@check("T9_bd_full_v2_cube", ORACLE["T9_bd_full_v2"])
def t9_cube(i):
    cube = _cube(i)
    return grids.bd_full_v2(None, i.payments(), i.kept("planos"), cube=cube)


# Payments of all months, so that their metrics are not zero outside two months.
@check("T4_bd_planos_uf_all_months", W.waterfall("uf", "TRUE"))
def t4_all(i):
    return grids.bd_planos_uf(i.stored_enriched(), i.payments(all_months=True))


@check("T5_bd_planos_mensais_sva_all_months", W.waterfall("sva", "TRUE"))
def t5_all(i):
    return grids.bd_planos_mensais_sva(i.stored_enriched(), i.payments(all_months=True))


@check("T8_bd_full_all_months", W.waterfall("full", "TRUE"))
def t8_all(i):
    return grids.bd_full(i.enriched(), i.payments(all_months=True), i.kept("planos"))


@check("T9_bd_full_v2_all_months", W.waterfall("full2", "TRUE"))
def t9_all(i):
    return grids.bd_full_v2(i.enriched(), i.payments(all_months=True), i.kept("planos"))


def _refreshed(i, version, build):
    """A table of rows as they were before a late correction, brought up to date by its touched months."""
    folder, now = sinks.scratch_folder(i.spark), i.stored_enriched()
    wrong = F.col("mes_base").isin(date(1995, 3, 1), date(1997, 11, 1)) & (F.pmod(F.xxhash64("advertiser_id"), F.lit(3)) == 0)
    late = (F.col("mes_base") == date(1996, 7, 1)) & (F.col("canal_conta") == "Online")
    # A change of stored rows, row by row, so it is not stored itself.
    before = now.where(~F.coalesce(late, F.lit(False))).withColumns({
        "faturado_mes": F.when(wrong, F.col("faturado_mes") * 2).otherwise(F.col("faturado_mes")).cast("decimal(18,2)"),
        "dt_cancelado": F.when(wrong, F.lit(date(1998, 1, 1))).otherwise(F.col("dt_cancelado")),
    })
    paid, plans = sinks.stored(i.payments()), i.kept("planos") if version in (grids.FULL, grids.FULL2) else None
    path = f"{folder}/{version}"
    cube = refresh.store_cube(before, folder)
    sinks.overwrite(build(paid, plans, cube), path, refresh.CELL)
    changed = sinks.stored(refresh.changed_rows(before, now, now.where(wrong | late)))
    cube = refresh.refresh_cube(now, folder, refresh.base_months(changed))
    refresh.refresh_table(version, path, cube, paid, plans, refresh.cell_months(changed))
    return versions.read(i.spark, path)


@check("T4_refresh_of_touched_months", ORACLE["T4_bd_planos_uf"])
def t4_refresh(i):
    return _refreshed(i, grids.UF, lambda paid, plans, cube: grids.bd_planos_uf(None, paid, cube=cube))


@check("T9_refresh_of_touched_months", ORACLE["T9_bd_full_v2"])
def t9_refresh(i):
    return _refreshed(i, grids.FULL2, lambda paid, plans, cube: grids.bd_full_v2(None, paid, plans, cube=cube))


@check("T12_tamanhos_ajustados_bucketed", ORACLE["T12_tamanhos_ajustados"])
def t12_bucketed(i):
    """From enriched rows stored by account: the lag moves nothing."""
    folder = sinks.scratch_folder(i.spark)
    name = f"cascata_{folder.rsplit('-', 1)[-1]}"
    # Gold has at most a row an order.
    buckets = sinks.buckets_for(i.table("orders").count(), 8)
    sinks.save_bucketed(i.enriched(), name, folder, ["advertiser_id"], ["mes_base"], buckets)
    return revenue.tamanhos_ajustados(i.spark.table(name), unique_months=True)
