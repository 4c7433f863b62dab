from datetime import date

from pyspark.sql import functions as F

from cascata import schemas
from cascata.operators import quality, reconcile
from cascata.plans import chain, crm, payments, recurring, revenue
from cascata.sources import ledger, modes, versions

D = date


def frame(spark, schema, *rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def gold(spark, *rows):
    base = {"classificacao": "Flat", "dt": D(2024, 6, 1), "estado": "RS", "pacote": "Plano 30"}
    return frame(spark, schemas.GOLD, *[{**base, **r} for r in rows])


def month(advertiser, m, channel, person="ana", **more):
    return {"advertiser_id": advertiser, "mes_base": D(2024, m, 1), "canal_conta": channel, "cordenador": person, **more}


COHORT = schemas.declare("advertiser_id string, mes_base date, data_vencimento_cohort date, data_pagamento_cohort date")
IDS = schemas.declare("advertiser_id string")


def test_enrichment_moves_flags_and_fan_out(spark):
    rows = gold(
        spark, month("1", 1, "Online"), month("1", 2, "Field", " bo "), month("2", 1, "Field"), month(None, 1, "Field"),
        month(None, 2, "ND"), month("3", 1, "Inside", classificacao="Novo"), month("3", 2, None),
    )
    twice = frame(spark, COHORT, *[{"advertiser_id": "2", "mes_base": D(2024, 1, 1)}] * 2)
    listed = frame(spark, IDS, {"advertiser_id": "2"}, {"advertiser_id": None})
    results = [
        revenue.receita_enriquecida(rows, listed, twice, unique_months=flag).collect() for flag in (True, False)
    ]
    assert sorted(map(str, results[0])) == sorted(map(str, results[1]))
    got = {(r.advertiser_id, r.mes_base.month): r for r in results[0]}
    assert len(results[0]) == 8  # cohort rows are not deduplicated
    moved = got["1", 2]
    assert (moved.status_migrado, moved.aux_canal_out, moved.coordenador_ajustado_out) == ("Migrado", "Online", "Online")
    assert moved.coordenador_ajustado == "BO" and moved.id_migracao_pro_field == "Sim"
    assert got["2", 1].id_migracao_pro_field == "Não" and got["2", 1].desconto_faseado == "Sim"
    assert got[None, 1].id_migracao_pro_field == "Não" and got[None, 1].desconto_faseado == "Não"
    assert got["3", 2].status_migrado is None
    fixed = revenue.receita_enriquecida(
        rows, listed, twice, transfer_list=listed,
        size_overrides=frame(spark, schemas.declare("advertiser_id string, tamanho string"), {"advertiser_id": "1", "tamanho": "X"}),
    )
    assert {r.advertiser_id for r in fixed.collect() if r.id_migracao_pro_field == "Sim"} == {"2"}


def test_payments_collapse_and_fall_back_to_latest(spark):
    rows = gold(spark, month("1", 4, "Field"), month("1", 5, "Online", ""), month("2", 1, "Inside"), month("2", 3, "Field"))
    paid = frame(
        spark, schemas.PAYMENTS,
        {"advertiser_id": "1", "mes_pago": D(2024, 5, 1), "status_ts": "b", "antecipado": 1.0, "dt": D(2024, 6, 2)},
        {"advertiser_id": "1", "mes_pago": D(2024, 5, 1), "status_ts": "a", "no_mes": 2.0, "dt": D(2024, 6, 2)},
        {"advertiser_id": "2", "mes_pago": D(2024, 6, 1), "status_ts": "a", "dt": D(2024, 6, 2)},
        {"advertiser_id": "2", "mes_pago": D(2024, 4, 1), "status_ts": "a", "dt": D(2024, 6, 2)},
        {"advertiser_id": "9", "mes_pago": D(2024, 6, 1), "status_ts": "a", "dt": D(2024, 6, 2)},
        {"advertiser_id": "1", "mes_pago": D(2024, 6, 1), "status_ts": "old", "dt": D(2024, 6, 1)},
    )
    build = lambda **o: payments.cb_pagamentos(rows, paid, D(2024, 6, 20), D(2024, 1, 1), **o)
    got = {(r.advertiser_id, r.mes_pago): r for r in build().collect()}
    assert set(got) == {("1", "01/05/2024"), ("2", "01/06/2024"), ("9", "01/06/2024")}
    one = got["1", "01/05/2024"]
    assert (one.status_ts, one.pago_mes, one.coordenador, one.coordenador_ajustado) == ("a", 2, "Online", "Online")
    assert (one.status_migrado, one.aux_canal_out) == ("Migrado", "Field")
    two = got["2", "01/06/2024"]
    assert (two.canal, two.id_migracao_pro_field, two.status_migrado) == ("Field", "Sim", "Migrado")
    nine = got["9", "01/06/2024"]
    assert (nine.canal, nine.coordenador_ajustado, nine.id_migracao_pro_field, nine.status_migrado) == (None, "", "Não", "Não")
    assert build(per_payment=True).count() == 4 and build(all_months=True).count() == 4
    assert build(months=[D(2024, 4, 1)]).count() == 1
    assert payments.payment_months(D(2024, 1, 5)) == [D(2024, 1, 1), D(2023, 12, 1)]


def plans(spark, *rows):
    base = {"canal": "Field", "estado_conta": "RS", "tamanho": "P", "status_recorrente": "Novo", "dt": D(2024, 6, 1), "package_name": "Plano 30"}
    return frame(spark, schemas.PLANS, *[{**base, **r} for r in rows])


def test_plan_ids_without_separator(spark):
    rows = plans(
        spark, {"id_conta_olx": 1, "id_contrato": 23, "competencia": D(2024, 5, 1), "valor_mensal": 1.0},
        {"id_conta_olx": 12, "id_contrato": 3, "competencia": D(2024, 5, 1), "valor_mensal": 2.0},
    )
    (joined,) = recurring.bd_planos_periodicos(rows).collect()
    (apart,) = recurring.bd_planos_periodicos(rows, separate_ids=True).collect()
    assert (joined.novos_qtd, apart.novos_qtd, joined.novos_valor) == (1, 2, 3.0)
    assert joined.chave_cruzamento == "FieldSulP"


def test_plan_changes_by_contract_and_by_account(spark):
    rows = plans(
        spark, *[{"id_conta_olx": 1, "id_contrato": k, "competencia": D(2024, m, 1), "valor_mensal": v}
                 for k, m, v in ((1, 4, 10.0), (2, 4, 30.0), (1, 5, 20.0))],
    )
    by_contract = {(r.id_contrato, r.competencia.month): r.delta for r in recurring.planos_periodicos(rows).collect()}
    by_account = {(r.id_contrato, r.competencia.month): r.delta for r in recurring.plans_by_account(rows).collect()}
    assert by_contract == {(1, 4): None, (2, 4): None, (1, 5): 10.0}
    assert by_account == {(1, 4): None, (2, 4): 20.0, (1, 5): -10.0}


def test_radar_and_sizes(spark):
    radar = frame(
        spark, schemas.RADAR, {"advertiser_id": "1", "base_date": D(2024, 5, 9), "dt": D(2024, 6, 1)},
        {"advertiser_id": "2", "dt": D(2024, 6, 1)}, {"advertiser_id": "3", "base_date": D(2024, 5, 9), "dt": D(2024, 5, 1)},
    )
    assert [(r.advertiser_id, r.mes_base) for r in crm.radar_cohort(radar).collect()] == [("1", D(2024, 5, 1))]
    sizes = spark.createDataFrame(
        [("1", D(2024, 1, 1), "P"), ("1", D(2024, 2, 1), "P"), ("1", D(2024, 3, 1), "M")], "advertiser_id string, mes_base date, tamanho_ajustado string"
    )
    got = sorted((r.mes_base.month, r.status_tamanho) for r in revenue.tamanhos_ajustados(sizes).collect())
    assert got == [(2, "OK"), (3, "Mudou")]


def test_chain_reports_failures_and_goes_on(spark, folder):
    steps = (
        chain.Step("bad", 1, ("src",), lambda f, day: f["src"].select("missing")),
        chain.Step("needs_bad", 2, ("bad",), lambda f, day: f["bad"]),
        chain.Step("good", 3, ("src",), lambda f, day: f["src"]),
        chain.Step("later", 4, ("good",), lambda f, day: f["good"], scheduled=False),
    )
    sources = {"src": spark.range(3)}
    outcomes = chain.run_chain(spark, sources, folder, D(2024, 1, 1), steps)
    assert [(o.name, o.status) for o in outcomes] == [("bad", "failed"), ("needs_bad", "blocked"), ("good", "done")]
    assert versions.read(spark, f"{folder}/good").count() == 3
    names = [s.name for s in sorted(chain.STEPS, key=lambda s: s.order) if s.scheduled and s.order > 0 and not s.helper]
    assert names == [
        "receita_consolidada", "cb_pagamentos", "receita_enriquecida", "bd_planos_uf", "bd_planos_mensais_sva",
        "planos_periodicos", "bd_planos_periodicos", "bd_full", "diarizacao",
    ]


def test_display_order(spark):
    df = spark.createDataFrame([("01/02/2024", "b"), ("01/12/2023", "a"), ("01/02/2024", "a")], "mes_pago string, advertiser_id string")
    got = [tuple(r) for r in chain.display(df, ("-mes_pago", "advertiser_id")).collect()]
    assert got == [("01/02/2024", "a"), ("01/02/2024", "b"), ("01/12/2023", "a")]


def test_gate_lists_every_failure(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),)], "dt date")
    passed, failures = quality.run_gate(
        {
            "rows": lambda: quality.has_rows("rows", df),
            "fresh": lambda: quality.is_fresh("fresh", df, "dt", D(2024, 1, 3)),
            "none": lambda: quality.is_fresh("none", df.limit(0), "dt", D(2024, 1, 3)),
            "broken": lambda: quality.has_rows("broken", df.select("nope")),
        }
    )
    assert not passed and len(failures) == 3
    assert quality.run_gate({"rows": lambda: quality.has_rows("rows", df)}) == (True, [])
    assert quality.gate_passed(quality.gate(quality.has_rows("rows", df))).first().passed


def test_reconciliation(spark):
    a = spark.createDataFrame([("x", 10.0), ("y", 100.0), ("only", 1.0)], "k string, v double")
    b = spark.createDataFrame([("x", 10.004), ("y", 104.0)], "k string, v double")
    (total,) = reconcile.compare_totals(a, b, ["v"]).collect()
    assert not total.matches and round(total.diff, 3) == 3.0
    groups = {r.k: round(r.diff, 3) for r in reconcile.compare_groups(a, b, ["k"], ["v"]).collect()}
    assert groups == {"x": 0.004, "y": 4.0, "only": -1.0}
    assert reconcile.compare_groups(a, b, ["k"], ["v"], how="inner").count() == 2
    assert {r.k: r.lacking for r in reconcile.compare_cells(a, b, "k", ["v"]).collect()} == {"x": None, "y": None, "only": "right"}
    cells = {r.k: r.matches for r in reconcile.compare_cells(a, b, "k", ["v"]).collect()}
    assert cells == {"x": True, "y": True, "only": False}
    cells = {r.k: r.matches for r in reconcile.compare_cells(a, b, "k", ["v"], share=0.01).collect()}
    assert cells == {"x": True, "y": False, "only": False}


def test_plans_have_no_cross_or_nested_loop_join(spark):
    rows = gold(spark, month("1", 1, "Online"))
    radar = frame(spark, COHORT)
    table = revenue.receita_enriquecida(rows, frame(spark, IDS), radar)
    paid = payments.cb_pagamentos(rows, frame(spark, schemas.PAYMENTS), D(2024, 6, 1))
    for df in (table, paid):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_group_run_keeps_failures_apart(spark, folder):
    day = D(2024, 1, 15)
    frame = lambda *v: spark.createDataFrame([(x, day) for x in v], "v string, dt date")
    broken = frame("x").withColumn("v", F.raise_error(F.lit("lost")))
    kinds = {"good": modes.DAILY, "bad": modes.DAILY, "slow": "weekly", "quiet": modes.HOURLY}
    tables = [modes.SourceTable(n, "dt", group=g) for n, g in kinds.items()]
    sources = {"good": frame("a", "b"), "bad": broken, "slow": frame("s"), "quiet": frame()}

    def fails(f, d):
        raise ValueError("no")

    steps = (
        chain.Step("counted", 1, ("good",), lambda f, d: f["good"].groupBy().count()),
        chain.Step("wrong", 2, ("good",), fails),
        chain.Step("needs_bad", 3, ("bad",), lambda f, d: f["bad"]),
        chain.Step("needs_slow", 4, ("slow",), lambda f, d: f["slow"]),
        chain.Step("needs_quiet", 5, ("quiet",), lambda f, d: f["quiet"]),
    )
    book = ledger.Ledger(spark, folder + "/ledger")
    run = lambda **o: {o.name: o.status for o in chain.run_group(spark, sources, tables, folder, book, day, steps=steps, **o)}
    assert run(month="2024-01") == dict.fromkeys(kinds, modes.NOT_HISTORICAL)
    first = run()
    assert first == {
        "good": chain.DONE, "bad": chain.FAILED, "slow": chain.DONE, "quiet": ledger.SKIPPED,
        "counted": chain.DONE, "wrong": chain.FAILED, "needs_bad": chain.BLOCKED, "needs_slow": chain.DONE,
        "needs_quiet": chain.BLOCKED,
    }
    assert versions.read(spark, folder + "/counted").first()[0] == 2
    # A source of another cadence is read as it was left; the failed one stays out.
    again = run(group=modes.DAILY)
    assert "slow" not in again and again["needs_slow"] == chain.DONE and again["needs_bad"] == chain.BLOCKED
