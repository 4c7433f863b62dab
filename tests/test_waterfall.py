import random
from datetime import date

from cascata import schemas
from cascata.operators.waterfall import ONE, Metric, Part, Role, Source, Waterfall
from cascata.plans import grids

MONTHS = [date(2024, m, 1) for m in range(1, 7)]
LETTERS = "id string, a string, m date, gone date, v double, w string"


def random_rows(n, seed):
    rng = random.Random(seed)
    pick = lambda xs: rng.choice(xs)
    return [
        (pick(["1", "2", "3", None]), pick(["x", "x", "x", "y", "", None]), pick([*MONTHS, None]),
         pick([None, None, *MONTHS]), pick([None, 1.0, 2.5, -4.0]), pick(["u", "d", None]))
        for _ in range(n)
    ]


def shifted(m):
    return None if m is None else date(m.year + m.month // 12, m.month % 12 + 1, 1)


def test_against_brute_force(spark):
    rows = random_rows(400, 5)
    roles = {
        "CUR": Role({"A": "a", "M": "m"}, "a IS NOT NULL AND a <> ''"),
        "NEXT": Role({"A": "a", "M": "add_months(m, 1)"}),
        "GONE": Role({"A": "a", "M": "gone"}),
    }
    metrics = [
        Metric("opening", (Part("r", "NEXT", "gone IS NULL OR gone <> m"), Part("r", "CUR", "w = 'u'", ONE, -1))),
        Metric("ups", (Part("r", "CUR", "w = 'u'", "v"),)),
        Metric("lost", (Part("r", "GONE", "w = 'd'", "v", -1),)),
        Metric("people", (Part("r", "CUR", "w = 'u'", ONE, 1, True),)),
        Metric("leavers", (Part("r", "GONE", "TRUE", ONE, -1, True), Part("r", "CUR", "w = 'd'", ONE, 1, True))),
    ]
    frame = spark.createDataFrame(rows, LETTERS)
    cells = {(r[1], r[2]) for r in rows if r[1]}
    expected = {}
    for a, m in cells:
        here = [r for r in rows if a is not None and m is not None and r[1] == a]
        cur = [r for r in here if r[2] == m]
        nxt = [r for r in here if shifted(r[2]) == m]
        gone = [r for r in here if r[3] == m]
        ids = lambda rs: len({r[0] for r in rs} - {None})
        expected[a, m] = (
            sum(r[3] is None or r[3] != r[2] for r in nxt) - sum(r[5] == "u" for r in cur),
            sum(r[4] or 0 for r in cur if r[5] == "u"),
            -sum(r[4] or 0 for r in gone if r[5] == "d"),
            ids([r for r in cur if r[5] == "u"]),
            ids([r for r in cur if r[5] == "d"]) - ids(gone),
        )
    for one_pass in (False, True):
        source = Source(frame, roles, ["a", "m", "gone"], id="id", one_pass=one_pass)
        got = Waterfall(("A", "M"), metrics, {"r": source}).build().collect()
        assert {(r.A, r.M): tuple(r)[2:] for r in got} == expected
        assert len(got) == len(cells)


def test_grid_without_metrics(spark):
    frame = spark.createDataFrame(random_rows(50, 2), LETTERS)
    role = Role({"A": "a", "M": "m"}, "a = 'x'")
    got = Waterfall(("A", "M"), [], {"r": Source(frame, {"CUR": role}, ["a", "m"])}).build()
    assert {(r.A, r.M) for r in got.collect()} == {(r.a, r.m) for r in frame.where("a = 'x'").collect()}


# ---- rules of the full tables ------------------------------------------------------------------

BASE = {
    "advertiser_id": "1", "mes_base": date(2024, 5, 1), "canal_conta": "Field", "coordenador_ajustado": "ANA",
    "cordenador": "ana", "regionalizacao": "Sul", "tamanho_ajustado": "PP", "id_migracao_pro_field": "Não",
    "faturado_mes": 10.0, "delta": 1.0, "classificacao": "Flat", "classificacao_churn": None, "status_ts": "1-Paid",
    "dt_cancelado": None, "status_migrado": None, "aux_canal_out": None, "coordenador_ajustado_out": None,
    "day_base": date(2024, 5, 2), "estado": "RS", "apoio_qtd_campanha": None, "apoio_qtd_sva": None,
    "faturado_mes_campanha": None, "faturado_mes_bairro_vip": None, "faturado_mes_topo_fixo": None,
    "pago_mes_campanha": None, "pago_mes_bairro": None, "pago_mes_topo": None, "volume_transcorrido": 0.0,
}
INTS = {"apoio_qtd_campanha", "apoio_qtd_sva"}
DATES = {"mes_base", "dt_cancelado", "day_base"}
DOUBLES = {k for k in BASE if k.startswith(("faturado", "pago", "delta", "volume"))}


def enriched(spark, *changes):
    kind = lambda k: "int" if k in INTS else "date" if k in DATES else "double" if k in DOUBLES else "string"
    schema = schemas.declare(", ".join(f"{k} {kind(k)}" for k in BASE))
    return spark.createDataFrame([tuple({**BASE, **change}.values()) for change in changes], schema)


def plans(spark, *rows):
    names = "canal coordenador_conta estado_conta cidade_conta tamanho status status_recorrente".split()
    schema = schemas.declare(
        ", ".join(f"{n} string" for n in names) + ", competencia date, mes_churn date, valor_mensal double, dt date"
    )
    base = dict(zip(names, ["Field", "ana", "RS", None, "PP", "OPEN", "flat"]))
    base |= {"competencia": date(2024, 4, 1), "mes_churn": None, "valor_mensal": 7.0, "dt": date(2024, 6, 1)}
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


PAYMENT = "canal string, coordenador_ajustado string, regionalizacao string, tamanho string, id_migracao_pro_field string, uf string, mes_pago string, antecipado string, no_mes string, transcorrido string"


def payments(spark, *rows):
    return spark.createDataFrame(list(rows), PAYMENT)


def cells(frame):
    return {(r.Canal, r.Equipe, r.Mes_Base, r.Tamanho, r.Transferencias): r for r in frame.collect()}


MAY, JUNE = date(2024, 5, 1), date(2024, 6, 1)


def test_payment_amounts_as_text_and_teams_by_case(spark):
    rows = enriched(spark, {}, {"canal_conta": "Online", "coordenador_ajustado": "ONLINE"})
    paid = payments(
        spark,
        ("Field", "ANA", "Sul", "P", "Não", "RS", "01/05/2024", "5.5", "x", "0"),
        ("Online", "Online", "Sul", "P", "Não", "RS", "01/05/2024", "9", "1", "1"),
    )
    none = plans(spark, {"dt": JUNE, "canal": ""})
    full = cells(grids.bd_full(rows, paid, none))
    field, online = full["Field", "ANA", MAY, "P", "Não"], full["Online", "ONLINE", MAY, "P", "Não"]
    assert (field.pagamentos_adiantados_valor, field.pagamentos_no_mes_valor, field.pagamentos_transcorridos_qtd) == (5.5, 0, 0)
    assert online.pagamentos_adiantados_qtd == 0  # 'Online' never meets 'ONLINE'
    fixed = cells(grids.bd_full(rows, paid, none, normalize_keys=True))
    assert fixed["Online", "ONLINE", MAY, "P", "Não"].pagamentos_adiantados_valor == 9.0


def test_moves_out_show_on_both_flags_in_v2_only(spark):
    left = {"status_migrado": "Migrado", "aux_canal_out": "Inside", "coordenador_ajustado_out": "ANA", "id_migracao_pro_field": "Sim"}
    inside = {"canal_conta": "Inside", "advertiser_id": "2"}
    rows = enriched(spark, left, inside, {**inside, "id_migracao_pro_field": "Sim"})
    none, paid = plans(spark, {"canal": ""}), payments(spark, ("z", "z", "z", "z", "z", "z", "x", "1", "1", "1"))
    v1, v2 = cells(grids.bd_full(rows, paid, none)), cells(grids.bd_full_v2(rows, paid, none))
    out = lambda t: [t["Inside", "ANA", MAY, "P", f].base_migracao_out_qtd for f in ("Sim", "Não")]
    assert out(v1) == [1, 0] and out(v2) == [1, 1]
    assert v1["Inside", "ANA", MAY, "P", "Sim"].base_inicial_qtd == -1
    assert ("Field", "ANA", JUNE, "P", "Sim") in v2 and ("Field", "ANA", JUNE, "P", "Sim") not in v1


def test_plan_rules_differ_by_version(spark):
    rows = enriched(spark, {}, {"canal_conta": "Online", "coordenador_ajustado": "ONLINE"})
    some = plans(
        spark, {"valor_mensal": -3.0}, {"valor_mensal": -2.0, "mes_churn": date(2024, 7, 1)},
        {"canal": "Online", "coordenador_conta": "ana"}, {"canal": "Online", "coordenador_conta": None},
        {"dt": date(2024, 5, 1), "valor_mensal": 1000.0},  # an older snapshot
    )
    paid = payments(spark, ("z", "z", "z", "z", "z", "z", "x", "1", "1", "1"))
    v1, v2 = cells(grids.bd_full(rows, paid, some)), cells(grids.bd_full_v2(rows, paid, some))
    field, online = ("Field", "ANA", MAY, "P", "Não"), ("Online", "ONLINE", MAY, "P", "Não")
    assert (v1[field].base_inicial_valor, v2[field].base_inicial_valor) == (-5.0, -3.0)
    assert (v1[online].base_inicial_qtd, v2[online].base_inicial_qtd) == (2, 1)
    assert v2[field].base_inicial_pago_valor == -3.0


def test_opening_value_of_v2_needs_positive_billing(spark):
    rows = enriched(spark, {"faturado_mes": -4.0}, {"faturado_mes": 6.0}, {"mes_base": JUNE})
    none, paid = plans(spark, {"canal": ""}), payments(spark, ("z", "z", "z", "z", "z", "z", "x", "1", "1", "1"))
    key = ("Field", "ANA", JUNE, "P", "Não")
    assert cells(grids.bd_full(rows, paid, none))[key].base_inicial_valor == 2.0
    assert cells(grids.bd_full_v2(rows, paid, none))[key].base_inicial_valor == 6.0


def test_accounts_count_once_in_the_state_table(spark):
    rows = enriched(spark, {"classificacao": "Novo"}, {"classificacao": "Novo"}, {"advertiser_id": "2", "classificacao": "Novo"})
    paid = payments(spark, ("z", "z", "z", "z", "z", "z", "x", "1", "1", "1"))
    (row,) = grids.bd_planos_uf(rows, paid).collect()
    assert (row.novos_qtd, row.novos_valor, row.UF) == (2, 30.0, "RS")
    (row,) = grids.bd_planos_mensais_sva(rows, paid).collect()
    assert row.novos_qtd == 2


def test_metric_counts():
    names = lambda v: [m.name for m in grids.metrics(v)]
    sizes = {v: len(set(names(v))) for v in (grids.UF, grids.SVA, grids.FULL, grids.FULL2)}
    assert sizes == {grids.UF: 33, grids.SVA: 49, grids.FULL: 55, grids.FULL2: 55}
