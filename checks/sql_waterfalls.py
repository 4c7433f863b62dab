"""Checking texts of the waterfall tables: one grouped branch per metric term, then a join.

A term is (metric, source, key, condition, value). Branches are stacked in long form, joined to
the grid of cells and spread into columns.
"""

from __future__ import annotations

from checks import sql_parts as S

ROWS = f"""r AS MATERIALIZED (SELECT *, {S.fold('tamanho_ajustado')} AS sz, id_migracao_pro_field AS tr FROM enr)"""
PLANS = f"""pp AS MATERIALIZED (SELECT *, {S.region('estado_conta', 'cidade_conta')} AS rg,
 {S.team('canal', 'coordenador_conta', 'ONLINE', 'ND')} AS eq, {S.fold('tamanho')} AS sz, 'Não' AS tr
 FROM planos WHERE dt = (SELECT max(dt) FROM planos))"""
BOTH_FLAGS = "(VALUES ('Sim'), ('Não')) AS f(flag)"

NEXT_MONTH = "CAST(mes_base + INTERVAL 1 MONTH AS DATE)"
KEYS = {
    "cur": "canal_conta, coordenador_ajustado, regionalizacao, mes_base, sz",
    "next": f"canal_conta, coordenador_ajustado, regionalizacao, {NEXT_MONTH}, sz",
    "churn": "canal_conta, coordenador_ajustado, regionalizacao, dt_cancelado, sz",
    "raw": "canal_conta, cordenador, regionalizacao, mes_base, sz",
    "out": "aux_canal_out, coordenador_ajustado_out, regionalizacao, mes_base, sz",
    "outchurn": "aux_canal_out, coordenador_ajustado_out, regionalizacao, dt_cancelado, sz",
    "pp": "canal, eq, rg, competencia, sz",
    "ppnext": "canal, eq, rg, CAST(competencia + INTERVAL 1 MONTH AS DATE), sz",
    "ppchurn": "canal, eq, rg, mes_churn, sz",
    "cb": "canal, coordenador_ajustado, regionalizacao, CAST(strptime(mes_pago, '%d/%m/%Y') AS DATE), tamanho",
}
CB_CLEAN = (
    "coalesce(trim(canal), ''), coalesce(trim(coordenador_ajustado), ''), CASE regionalizacao "
    "WHEN 'RJ+MG+ES' THEN 'RJ' WHEN 'N+NE+CO' THEN 'NE' ELSE trim(regionalizacao) END, "
    "CAST(strptime(mes_pago, '%d/%m/%Y') AS DATE), coalesce(trim(tamanho), '')"
)

KEPT = "(dt_cancelado IS NULL OR dt_cancelado <> mes_base)"
PP_KEPT = "(mes_churn IS NULL OR mes_churn <> competencia)"
NEW, UP, DOWN = (f"classificacao = '{v}'" for v in ("Novo", "Upgrade", "Downgrade"))
GONE, BACK = "classificacao_churn = 'CHURN'", "classificacao_churn = 'CHURN - Recuperado'"
PAID, MOVED = "status_ts = '1-Paid'", "status_migrado = 'Migrado'"
PP_NEW, PP_GONE = "status_recorrente = 'Novo'", "status_recorrente = 'Churn'"
FAT = "sum(faturado_mes)"
VAL = "sum(valor_mensal)"


def _nz(*names: str) -> str:
    return "(" + " OR ".join(f"{n} <> 0" for n in names) + ")"


def terms(version: str) -> list[tuple[str, str, str, str]]:
    """(metric, key, condition, value) of each term."""
    full = version in ("full", "full2")
    n = "count(*)" if full else "count(DISTINCT advertiser_id)"
    neg = lambda v: f"-{v}"
    v2 = version == "full2"
    late = (
        "day_base > last_day(mes_base) - INTERVAL 6 DAY AND day_base <= last_day(mes_base) AND "
        "(dt_cancelado IS NULL OR date_trunc('month', dt_cancelado) <> date_trunc('month', mes_base))"
    )
    bv, tf = "faturado_mes_bairro_vip", "faturado_mes_topo_fixo"
    t = [
        ("base_inicial_qtd", "next", KEPT, n),
        ("novos_qtd", "cur", NEW, n),
        ("churn_qtd", "churn", GONE, neg(n)),
        ("base_inicial_valor", "next", KEPT + (" AND faturado_mes > 0" if v2 else ""), FAT),
        ("novos_valor", "cur", NEW, FAT),
        ("up_valor", "cur", UP, "sum(delta)"),
        ("down_valor", "cur", DOWN, "sum(delta)"),
        ("churn_valor", "churn", GONE, neg(FAT)),
        ("recuperados_valor", "cur", BACK, FAT),
        ("recuperados_novos_valor", "cur", f"{BACK} AND {NEW}", FAT),
        ("campanha_qtd", "cur", _nz("faturado_mes_campanha"), n),
        ("campanha_valor", "cur", "TRUE", "sum(faturado_mes_campanha)"),
        ("sva_qtd", "cur", _nz(bv, tf), n),
        ("sva_valor", "cur", "TRUE", f"sum(coalesce({bv}, 0) + coalesce({tf}, 0))"),
        ("pagamentos_adiantados_valor", "cb", "TRUE", "sum(antecipado)"),
        ("pagamentos_no_mes_valor", "cb", "TRUE", "sum(no_mes)"),
        ("pagamentos_transcorridos_valor", "cb", "TRUE", "sum(transcorrido)"),
        ("pagamento_campanha_valor", "cur", "TRUE", "sum(pago_mes_campanha)"),
        ("pagamento_sva_valor", "cur", "TRUE", "sum(coalesce(pago_mes_bairro, 0) + coalesce(pago_mes_topo, 0))"),
        ("pagamentos_adiantados_qtd", "cb", "antecipado <> 0", "count(*)"),
        ("pagamentos_no_mes_qtd", "cb", "no_mes <> 0", "count(*)"),
        ("pagamentos_transcorridos_qtd", "cb", "transcorrido <> 0", "count(*)"),
        ("pagamento_campanha_qtd", "raw", "TRUE", "sum(apoio_qtd_campanha)"),
        ("pagamento_sva_qtd", "raw", "TRUE", "sum(apoio_qtd_sva)"),
        ("up_qtd", "cur", UP, n),
        ("down_qtd", "cur", DOWN, n),
        ("base_inicial_pago_valor", "next", f"{PAID} AND {KEPT}", FAT),
        ("novos_pago_valor", "cur", f"{PAID} AND {NEW}", FAT),
        ("up_pago_valor", "cur", f"{PAID} AND {UP}", "sum(delta)"),
        ("down_pago_valor", "cur", f"{PAID} AND {DOWN}", "sum(delta)"),
        ("churn_pago_valor", "churn", f"{PAID} AND {GONE}", neg(FAT)),
        ("recuperados_pago_valor", "cur", f"{PAID} AND {BACK}", FAT),
        ("recuperados_novos_pago_valor", "cur", f"{PAID} AND {BACK} AND {NEW}", FAT),
    ]
    if version == "uf":
        return t
    for side, cur, gone in (("in", "cur", "churn"), ("out", "out", "outchurn")):
        t += [
            (f"churn_migracao_{side}_qtd", gone, f"{GONE} AND {MOVED}", neg(n)),
            (f"up_migracao_{side}_qtd", cur, f"{UP} AND {MOVED}", n),
            (f"down_migracao_{side}_qtd", cur, f"{DOWN} AND {MOVED}", n),
            (f"churn_migracao_{side}_valor", gone, f"{GONE} AND {MOVED}", neg(FAT)),
            (f"up_migracao_{side}_valor", cur, f"{UP} AND {MOVED}", "sum(delta)"),
            (f"down_migracao_{side}_valor", cur, f"{DOWN} AND {MOVED}", "sum(delta)"),
            (f"base_migracao_{side}_valor", cur, MOVED, FAT),
            (f"base_migracao_{side}_qtd", cur, MOVED, n),
        ]
        if full:
            t += [
                (f"churn_{side}_bi_qtd", gone, f"{GONE} AND {MOVED} AND mes_base = dt_cancelado", neg(n)),
                (f"churn_{side}_bi_valor", gone, f"{GONE} AND {MOVED} AND mes_base = dt_cancelado", neg(FAT)),
            ]
    if not full:
        return t
    pp_count = PP_KEPT + (
        " AND (canal NOT IN ('Online', 'ND') OR coalesce(coordenador_conta, '') = '')" if v2 else ""
    )
    pp_value = "mes_churn IS NULL OR mes_churn <> competencia AND valor_mensal > 0" if v2 else PP_KEPT
    t += [
        ("base_inicial_qtd", "cur", MOVED, n),
        ("base_inicial_qtd", "out", MOVED, neg(n)),
        ("base_inicial_qtd", "ppnext", pp_count, n),
        ("novos_qtd", "pp", PP_NEW, n),
        ("churn_qtd", "ppchurn", PP_GONE, neg(n)),
        ("base_inicial_valor", "ppnext", pp_value, VAL),
        ("novos_valor", "pp", PP_NEW, VAL),
        ("churn_valor", "ppchurn", PP_GONE, neg(VAL)),
        ("pagamentos_no_mes_valor", "pp", "status = 'PAID'", VAL),
        ("pagamentos_no_mes_qtd", "pp", "status = 'PAID'", n),
        ("novos_pago_valor", "pp", PP_NEW, VAL),
        ("churn_pago_valor", "ppchurn", PP_GONE, neg(VAL)),
    ]
    if v2:
        return t + [
            ("base_inicial_pago_valor", "ppnext", pp_value, VAL),
            ("volume_transcorrido_valor", "next", "TRUE", "sum(volume_transcorrido)"),
            ("volume_transcorrido_qtd", "next", "volume_transcorrido > 0", n),
        ]
    return t + [
        ("base_inicial_pago_valor", "pp", "status_recorrente IN ('flat', 'Churn')", VAL),
        ("base_inicial_pago_valor", "ppchurn", PP_GONE, VAL),
        ("volume_transcorrido_valor", "next", late, FAT),
        ("volume_transcorrido_qtd", "next", late, n),
    ]


def _branch(version: str, metric: str, key: str, condition: str, value: str) -> str:
    source = {"pp": "pp", "cb": "cb"}.get(key[:2], "r")
    columns = CB_CLEAN if version == "full2" and key == "cb" else KEYS[key]
    extra = ""
    if version in ("full", "full2"):
        extra = ", " + {"pp": "tr", "r": "tr", "cb": "id_migracao_pro_field"}[source]
        if version == "full2" and key.startswith("out"):
            extra, source = ", flag", f"r, {BOTH_FLAGS}"
    if version == "uf":
        extra = ", uf" if source == "cb" else ", estado"
    return (
        f"SELECT {columns}{extra}, '{metric}' AS k, CAST({value} AS DECIMAL(38,2)) AS v "
        f"FROM {source} WHERE {condition} GROUP BY ALL"
    )


GRIDS = {
    "uf": "SELECT DISTINCT canal_conta, coordenador_ajustado, regionalizacao, mes_base, sz, estado FROM r "
    "WHERE canal_conta <> '' AND coordenador_ajustado <> '' AND estado <> ''",
    "sva": "SELECT DISTINCT canal_conta, coordenador_ajustado, regionalizacao, mes_base, sz FROM r "
    "WHERE canal_conta <> '' AND coordenador_ajustado <> ''",
    "full": f"SELECT {KEYS['cur']}, tr FROM r WHERE canal_conta <> '' UNION "
    f"SELECT {KEYS['pp']}, tr FROM pp WHERE canal <> '' AND sz <> ''",
    "full2": " UNION ".join(
        [
            f"SELECT {KEYS['cur']}, tr FROM r WHERE canal_conta <> ''",
            f"SELECT {KEYS['next']}, tr FROM r WHERE canal_conta <> ''",
            f"SELECT {KEYS['churn']}, tr FROM r WHERE canal_conta <> '' AND dt_cancelado IS NOT NULL",
            f"SELECT {KEYS['pp']}, tr FROM pp WHERE canal <> ''",
            f"SELECT {KEYS['ppnext']}, tr FROM pp WHERE canal <> ''",
            f"SELECT {KEYS['out']}, tr FROM r WHERE {MOVED}",
        ]
    ),
}


def _dims(version: str) -> list[str]:
    last = {"uf": ["UF"], "sva": []}.get(version, ["Transferencias"])
    return ["Canal", "Equipe", "Regiao_Macro", "Mes_Base", "Tamanho", *last]


def grid(version: str) -> str:
    plans = ("planos",) if version.startswith("full") else ()
    extra = ROWS + (f", {PLANS}" if plans else "")
    names = ", ".join(_dims(version))
    return S.enriched(
        f"SELECT * FROM ({GRIDS[version]}) AS g({names})", extra, *plans
    )


DERIVED = {
    "uf": "",
    "sva": "",
    "full": ", recuperados_pago_valor - churn_pago_valor AS cancelamento_total_pago_valor",
    "full2": ", base_inicial_valor + novos_valor + up_valor + down_valor + churn_valor + base_migracao_in_valor - base_migracao_out_valor AS base_final_valor"
    ", base_inicial_pago_valor + novos_pago_valor + up_pago_valor + down_pago_valor + churn_pago_valor AS base_final_pago_valor"
    ", base_inicial_qtd + novos_qtd + churn_qtd + base_migracao_in_qtd - base_migracao_out_qtd AS base_final_qtd"
    ", churn_valor + recuperados_valor AS cancelamento_total_valor"
    ", recuperados_pago_valor - churn_pago_valor AS cancelamento_total_pago_valor",
}


def waterfall(version: str, paid_months: str = S.TWO_MONTHS) -> str:
    dims = _dims(version)
    names = list(dict.fromkeys(m for m, *_ in terms(version)))
    stacked = "\nUNION ALL ".join(_branch(version, *t) for t in terms(version))
    spread = ", ".join(f"coalesce(sum(CASE WHEN k = '{m}' THEN v END), 0) AS {m}" for m in names)
    same = " AND ".join(f"c.{d} = g.{d}" for d in dims)
    plans = ("planos",) if version.startswith("full") else ()
    key = "" if version == "sva" else ", Canal || Equipe AS chave_equipe_coordenador"
    extra = ", ".join(
        [
            S.payments(paid_months),
            ROWS,
            *([PLANS] if plans else []),
            f"cells({', '.join(dims)}, k, v) AS ({stacked})",
            f"grid({', '.join(dims)}) AS ({GRIDS[version]})",
            f"wide AS (SELECT {', '.join('g.' + d for d in dims)}, {spread} FROM grid g LEFT JOIN cells c ON {same} GROUP BY ALL)",
            f"done AS (SELECT *{DERIVED[version]} FROM wide)",
        ]
    )
    return S.enriched(
        f"SELECT {', '.join(dims)}{key}, CAST(COLUMNS('_valor$') AS DOUBLE), CAST(COLUMNS('_qtd$') AS BIGINT) FROM done",
        extra,
        "paids",
        *plans,
    )


def plan_waterfall() -> str:
    """The recurring-plan table, distinct contracts."""
    key = "canal, equipe_ajustada, regionalizacao, {m}, tamanho"
    cur, nxt, gone = (
        key.format(m=m)
        for m in ("competencia", "CAST(competencia + INTERVAL 1 MONTH AS DATE)", "mes_churn")
    )
    ids = "count(DISTINCT CAST(id_conta_olx AS VARCHAR) || CAST(id_contrato AS VARCHAR))"
    spec = [
        ("base_inicial_qtd", nxt, PP_KEPT, ids),
        ("novos_qtd", cur, PP_NEW, ids),
        ("churn_qtd", gone, PP_GONE, f"-{ids}"),
        ("base_inicial_valor", nxt, PP_KEPT, VAL),
        ("novos_valor", cur, PP_NEW, VAL),
        ("up_valor", cur, "classifica_up = 'Upgrade'", "sum(delta)"),
        ("down_valor", cur, "classifica_up = 'Downgrade'", "sum(delta)"),
        ("churn_valor", gone, PP_GONE, f"-{VAL}"),
        ("up_qtd", cur, "classifica_up = 'Upgrade'", ids),
        ("down_qtd", cur, "classifica_up = 'Downgrade'", ids),
        ("pagamentos_no_mes_valor", cur, "status = 'PAID'", VAL),
    ]
    stacked = "\nUNION ALL ".join(
        f"SELECT {k}, '{m}' AS k, CAST({v} AS DECIMAL(38,2)) AS v FROM plan WHERE {w} GROUP BY ALL"
        for m, k, w, v in spec
    )
    dims = ["Canal", "Equipe", "Regiao_Macro", "Mes_Base", "Tamanho"]
    same = " AND ".join(f"c.{d} = g.{d}" for d in dims)
    spread = ", ".join(
        f"coalesce(sum(CASE WHEN k = '{m}' THEN v END), 0) AS {m}" for m, *_ in spec
    )
    return (
        S.with_views("planos")
        + ", "
        + S.plan_rows("id_conta_olx", "competencia, id_contrato", "Online", "ND", "NULL")
        + f", cells({', '.join(dims)}, k, v) AS ({stacked})"
        + f", grid({', '.join(dims)}) AS (SELECT DISTINCT {cur} FROM plan WHERE canal <> '' AND competencia IS NOT NULL AND regionalizacao <> '' AND tamanho <> '')"
        + f", wide AS (SELECT {', '.join('g.' + d for d in dims)}, {spread} FROM grid g LEFT JOIN cells c ON {same} GROUP BY ALL)"
        + f" SELECT {', '.join(dims)}, Canal || Equipe || Regiao_Macro || Tamanho AS chave_cruzamento, CAST(COLUMNS('_valor$') AS DOUBLE), CAST(COLUMNS('_qtd$') AS BIGINT) FROM wide"
    )
