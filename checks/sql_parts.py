"""Checking texts of the derived tables, written independently of the library."""

from __future__ import annotations

from checks.fixtures import with_views

AS_OF = "DATE '2000-06-15'"
SINCE = "DATE '1999-01-01'"

# State codes per region.
_STATES = {
    "Sul": "RS SC PR",
    "MG/ES": "MG ES",
    "RJ": "RJ",
    "NO/CO": "MS MT GO DF TO PA AP RO AC AM",
    "NE": "BA PI MA CE RN PB PE AL SE",
}


def region(state: str, city: str) -> str:
    lists = "\n".join(
        f" WHEN upper(trim({state})) IN ({', '.join(repr(s) for s in codes.split())}) THEN '{name}'"
        for name, codes in _STATES.items()
    )
    return (
        f"CASE WHEN coalesce(trim({state}), '') = '' THEN ''\n{lists}\n"
        f" WHEN upper(trim({state})) <> 'SP' THEN 'Outros'\n"
        f" WHEN upper(trim({city})) = 'SÃO PAULO' THEN 'Sp Capital'\n"
        " ELSE 'SP Interior & Litoral' END"
    )


def number(column: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({column}, '[0-9]+'), '') AS BIGINT)"


def band(n: str, null_as: str = "NULL") -> str:
    return (
        f"CASE WHEN {n} IS NULL THEN {null_as} WHEN {n} <= 25 THEN 'PP' WHEN {n} <= 80 THEN 'P' "
        f"WHEN {n} <= 600 THEN 'M' ELSE 'G' END"
    )


def team(channel: str, person: str, online: str, nd: str) -> str:
    return (
        f"CASE upper(trim({channel})) WHEN 'ONLINE' THEN '{online}' WHEN 'ND' THEN '{nd}' "
        f"ELSE coalesce(upper(trim({person})), '') END"
    )


def fold(size: str) -> str:
    return f"CASE WHEN {size} = 'PP' THEN 'P' ELSE {size} END"


COHORT = """cohort AS (SELECT advertiser_id, CAST(date_trunc('month', base_date) AS DATE) AS mes_base,
 expiration_date AS data_vencimento_cohort, payment_date AS data_pagamento_cohort
 FROM radar WHERE base_date IS NOT NULL AND dt = (SELECT max(dt) FROM radar))"""

DISCOUNT = """newest AS (SELECT max(year * 10000 + month * 100 + day) AS n FROM opportunity WHERE year >= 2000),
discount AS (SELECT DISTINCT a.idorigin__c AS advertiser_id, a.name AS nome_conta,
 CAST(NULL AS TIMESTAMP) AS data_ultima_mudanca_fase, o.stagename AS fase,
 CAST(o.amount AS DOUBLE) AS valor_total, CAST(NULL AS DOUBLE) AS valor_mensal,
 CAST(o.discountrecurringvalue__c AS DOUBLE) AS promocao_desconto_3meses,
 o.uniqueopportunityidentifier__c AS id_unico_oportunidade, CAST(NULL AS VARCHAR) AS origem_lead,
 CAST(NULL AS VARCHAR) AS gerado_por, CAST(NULL AS DOUBLE) AS pct_desconto,
 u.name AS proprietario_oportunidade
 FROM opportunity o
 JOIN account a ON a.id = o.accountid AND a.year * 10000 + a.month * 100 + a.day = (SELECT n FROM newest)
 LEFT JOIN crm_user u ON u.id = o.ownerid AND u.year * 10000 + u.month * 100 + u.day = (SELECT n FROM newest)
 WHERE o.year * 10000 + o.month * 100 + o.day = (SELECT n FROM newest)
 AND o.discountrecurringvalue__c NOT IN ('0', '0.0') AND a.idorigin__c <> ''
 AND a.idorigin__c IN (SELECT advertiser_id FROM gold WHERE dt = (SELECT max(dt) FROM gold)))"""

_ABSENT = (
    "classificacao_rec vigencia_bt status_ts_campanha status_ts_bairro_vip status_ts_topo_fixo "
    "dono_conta advertiser_industry"
).split()

ENRICHED = f"""cut AS (SELECT mes_base, min(d) AS first_late FROM (
  SELECT mes_base, d, row_number() OVER (PARTITION BY mes_base ORDER BY d DESC) AS k FROM (
   SELECT mes_base, CAST(unnest(generate_series(last_day(mes_base) - INTERVAL 15 DAY, CAST(last_day(mes_base) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
   FROM (SELECT DISTINCT mes_base FROM gold)) WHERE dayofweek(d) NOT IN (0, 6)) WHERE k <= 6 GROUP BY mes_base),
moved AS (SELECT DISTINCT advertiser_id FROM gold WHERE canal_conta = 'Field' AND classificacao <> 'Novo'
 AND advertiser_id IN (SELECT advertiser_id FROM gold WHERE canal_conta <> 'Field')),
lagged AS (SELECT *, LAG(canal_conta) OVER w AS prev_channel, LAG(cordenador) OVER w AS prev_person
 FROM gold WINDOW w AS (PARTITION BY advertiser_id ORDER BY mes_base NULLS FIRST)),
flagged AS (SELECT *, coalesce(classificacao <> 'Novo' AND prev_channel <> canal_conta, FALSE) AS is_moved FROM lagged),
enr AS (SELECT g.advertiser_id, g.mes_base, g.tamanho, pacote, estado, municipio, ultimo_mes_pagamento, status_ts,
 faturado_mes, classificacao, classificacao_churn, dt_cancelado, delta, day_base, day_churn,
 faturado_mes_campanha, pago_mes_campanha, faturado_mes_bairro_vip, pago_mes_bairro, faturado_mes_topo_fixo,
 pago_mes_topo, canal_conta, cordenador, dt, {', '.join(f'CAST(NULL AS VARCHAR) AS {c}' for c in _ABSENT)},
 CAST(NULL AS DOUBLE) AS total_faturado_sva, CAST(NULL AS DOUBLE) AS total_pago_sva,
 {region('estado', 'municipio')} AS regionalizacao,
 CASE WHEN pago_mes_campanha <> 0 THEN 1 END AS apoio_qtd_campanha,
 CASE WHEN pago_mes_topo <> 0 OR pago_mes_bairro <> 0 THEN 1 END AS apoio_qtd_sva,
 g.advertiser_id || CAST(g.mes_base AS VARCHAR) AS id_e_data,
 g.advertiser_id || CAST(ultimo_mes_pagamento AS VARCHAR) AS id_ajustado,
 nullif(regexp_extract(pacote, '[0-9]+'), '') AS tamanho_nr,
 CASE WHEN pacote ILIKE '%inser%' THEN coalesce(g.tamanho, pacote)
  ELSE coalesce({band(number('pacote'))}, g.tamanho, '') END AS tamanho_ajustado,
 {team('canal_conta', 'cordenador', 'ONLINE', 'ND')} AS coordenador_ajustado,
 CASE WHEN is_moved THEN 'Migrado' END AS status_migrado,
 prev_channel AS aux_canal_out, prev_person AS aux_coord_out,
 CASE WHEN NOT is_moved THEN NULL WHEN prev_channel IN ('Online', 'ND') THEN prev_channel ELSE prev_person END AS coordenador_ajustado_out,
 g.advertiser_id || CAST(dt_cancelado AS VARCHAR) AS chave_churn,
 CASE WHEN canal_conta = 'Field' AND g.advertiser_id IN (SELECT advertiser_id FROM moved) THEN 'Sim' ELSE 'Não' END AS id_migracao_pro_field,
 CASE WHEN g.advertiser_id IN (SELECT advertiser_id FROM discount) THEN 'Sim' ELSE 'Não' END AS desconto_faseado,
 data_vencimento_cohort, data_pagamento_cohort,
 CASE WHEN day_base >= first_late AND day_base <= last_day(g.mes_base)
  AND (data_pagamento_cohort IS NULL OR month(data_pagamento_cohort) = month(g.mes_base + INTERVAL 1 MONTH))
  AND (dt_cancelado IS NULL OR date_trunc('month', dt_cancelado) <> date_trunc('month', g.mes_base))
  THEN faturado_mes ELSE 0 END AS volume_transcorrido
 FROM flagged g LEFT JOIN cut ON cut.mes_base = g.mes_base
 LEFT JOIN cohort h ON h.advertiser_id = g.advertiser_id AND h.mes_base = g.mes_base)"""

_HISTORY = f"""hist0 AS (SELECT *, LAG(canal_conta, 1, 'inicio') OVER w AS pc, LAG(cordenador, 1, 'inicio') OVER w AS pp
 FROM gold WINDOW w AS (PARTITION BY advertiser_id ORDER BY mes_base NULLS FIRST)),
hist AS (SELECT *, coalesce(classificacao <> 'Novo' AND pc <> canal_conta, FALSE) AS mv,
 {region('estado', 'municipio')} AS rg,
 row_number() OVER (PARTITION BY advertiser_id ORDER BY mes_base DESC NULLS LAST) AS newest_first FROM hist0)"""


def payments(kept: str) -> str:
    """Candidates by the original rule: exact month or newest row, exact first, one row kept."""
    return f"""{_HISTORY},
cand AS (SELECT p.*, h.canal_conta, h.cordenador, h.estado, h.rg, h.tamanho, h.mv, h.pc, h.pp,
 row_number() OVER (PARTITION BY p.advertiser_id, p.mes_pago ORDER BY CASE WHEN h.mes_base = p.mes_pago THEN 1 ELSE 2 END,
  h.mes_base DESC NULLS LAST, p.status_ts NULLS FIRST, p.antecipado NULLS FIRST, p.no_mes NULLS FIRST, p.transcorrido NULLS FIRST, p.day_paid NULLS FIRST) AS k
 FROM (SELECT * FROM paids WHERE dt = (SELECT max(dt) FROM paids)) p
 LEFT JOIN hist h ON h.advertiser_id = p.advertiser_id AND (h.mes_base = p.mes_pago OR h.newest_first = 1)),
cb AS (SELECT advertiser_id, strftime(mes_pago, '%d/%m/%Y') AS mes_pago, strftime(day_paid, '%d/%m/%Y') AS day_paid, status_ts,
 coalesce(antecipado, 0) AS antecipado, coalesce(no_mes, 0) AS no_mes, coalesce(transcorrido, 0) AS transcorrido,
 coalesce(antecipado, 0) + coalesce(no_mes, 0) + coalesce(transcorrido, 0) AS pago_mes,
 strftime(dt, '%d/%m/%Y') AS dt, coalesce(nullif(cordenador, ''), canal_conta) AS coordenador, canal_conta AS canal,
 advertiser_id || CAST(date_diff('day', DATE '1899-12-30', mes_pago) AS VARCHAR) AS id_e_data,
 rg AS regionalizacao, estado AS uf, tamanho, CASE WHEN mv THEN 'Migrado' ELSE 'Não' END AS status_migrado,
 CASE WHEN canal_conta = 'Field' AND advertiser_id IN (SELECT advertiser_id FROM hist WHERE mv AND canal_conta = 'Field' AND mes_base >= {SINCE}) THEN 'Sim' ELSE 'Não' END AS id_migracao_pro_field,
 CASE WHEN canal_conta IN ('Online', 'ND') THEN canal_conta ELSE coalesce(upper(trim(cordenador)), '') END AS coordenador_ajustado,
 CASE WHEN mv THEN pc END AS aux_canal_out, CASE WHEN mv THEN pp END AS aux_coord_out
 FROM cand WHERE k = 1 AND {kept})"""


TWO_MONTHS = f"mes_pago IN (date_trunc('month', {AS_OF}), date_trunc('month', {AS_OF}) - INTERVAL 1 MONTH)"
PAYMENTS = payments(TWO_MONTHS)

ENRICHED_INPUTS = ("gold", "radar", "opportunity", "account", "crm_user")
MONEY = (
    "faturado_mes delta faturado_mes_campanha pago_mes_campanha faturado_mes_bairro_vip pago_mes_bairro "
    "faturado_mes_topo_fixo pago_mes_topo volume_transcorrido"
).split()


def doubles(*names: str, of: str = "*") -> str:
    casts = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)
    return f"{of} REPLACE ({casts})"


def enriched(select: str, extra: str = "", *views: str) -> str:
    """Text over the enriched rows ``enr``; ``extra`` are further WITH items."""
    head = with_views(*ENRICHED_INPUTS, *views)
    return f"{head},\n{COHORT},\n{DISCOUNT},\n{ENRICHED}{', ' + extra if extra else ''}\n{select}"


def plan_rows(keys: str, order: str, online: str, nd: str, null_size: str) -> str:
    n = number("package_name")
    return f"""plan0 AS (SELECT *, {region('estado_conta', 'cidade_conta')} AS regionalizacao,
 {team('canal', 'coordenador_conta', online, nd)} AS equipe_ajustada,
 valor_mensal - LAG(valor_mensal) OVER (PARTITION BY {keys} ORDER BY {order}) AS delta,
 {n} AS numero_pacote FROM planos WHERE dt = (SELECT max(dt) FROM planos)),
plan AS (SELECT *, CASE WHEN delta > 0 THEN 'Upgrade' WHEN delta < 0 THEN 'Downgrade' END AS classifica_up,
 {band('numero_pacote', null_size)} AS tamanho_oficial FROM plan0)"""
