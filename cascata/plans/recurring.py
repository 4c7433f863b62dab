"""Recurring plans: month-over-month change per contract and the plan waterfall."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.functions import business as B
from cascata.functions import text as T
from cascata.operators.ordered import add_delta
from cascata.operators.waterfall import ONE, Metric, Part, Role, Source, Waterfall
from cascata.sources.scans import snapshot

DIMS = ("Canal", "Equipe", "Regiao_Macro", "Mes_Base", "Tamanho")


def _plan_columns(plans: DataFrame, keys, order, online, nd, null_size, bounded, day, at_rest) -> DataFrame:
    c = F.col
    rows = add_delta(snapshot(plans, day), keys, order, "valor_mensal", bounded=bounded, at_rest=at_rest)
    cleaned = rows.withColumns(
        {
            "__state": T.clean_upper(c("estado_conta")),
            "__city": T.clean_upper(c("cidade_conta")),
            "__channel": T.clean_upper(c("canal")),
            "numero_pacote": T.first_number(c("package_name")),
        }
    )
    person = T.clean_upper(c("coordenador_conta"))
    return cleaned.withColumns(
        {
            "regionalizacao": B.region_of(c("__state"), c("__city")),
            "equipe_ajustada": B.team_of(c("__channel"), person, online, nd),
            "classifica_up": B.delta_class(c("delta")),
            "tamanho_oficial": B.official_size(c("package_name"), null_size, c("numero_pacote")),
        }
    ).drop("__state", "__city", "__channel")


def planos_periodicos(
    plans: DataFrame, bounded: bool = False, day: date | None = None, at_rest: bool = False
) -> DataFrame:
    """Latest plans with the change per contract; no package number counts as PP.

    ``day`` names the latest snapshot where it is known, here and below; plans ``at_rest`` are read from
    storage, so the lag does not write them once more.
    """
    return _plan_columns(
        plans, ["id_conta_olx", "id_contrato"], ["competencia"], "", "", "PP", bounded, day, at_rest
    )


def plans_by_account(
    plans: DataFrame, bounded: bool = False, day: date | None = None, at_rest: bool = False
) -> DataFrame:
    """Latest plans with the change per account (contracts in id order inside a month)."""
    return _plan_columns(
        plans, ["id_conta_olx"], ["competencia", "id_contrato"], "Online", "ND", None, bounded, day, at_rest
    )


def _metrics() -> list[Metric]:
    kept = "(mes_churn IS NULL OR mes_churn <> competencia)"
    new, gone = "status_recorrente = 'Novo'", "status_recorrente = 'Churn'"
    up, down = (f"classifica_up = '{v}'" for v in (B.UP, B.DOWN))

    def count(name, role, where, sign=1):
        return Metric(name, (Part("plans", role, where, ONE, sign, True),))

    def total(name, role, where, value, sign=1):
        return Metric(name, (Part("plans", role, where, value, sign),))

    return [
        count("base_inicial_qtd", "NEXT", kept),
        count("novos_qtd", "CUR", new),
        count("churn_qtd", "CHURN", gone, -1),
        total("base_inicial_valor", "NEXT", kept, "valor_mensal"),
        total("novos_valor", "CUR", new, "valor_mensal"),
        total("up_valor", "CUR", up, "delta"),
        total("down_valor", "CUR", down, "delta"),
        total("churn_valor", "CHURN", gone, "valor_mensal", -1),
        count("up_qtd", "CUR", up),
        count("down_qtd", "CUR", down),
        total("pagamentos_no_mes_valor", "CUR", "status = 'PAID'", "valor_mensal"),
    ]


def _roles() -> dict[str, Role]:
    def at(month):
        return dict(zip(DIMS, ("canal", "equipe_ajustada", "regionalizacao", month, "tamanho")))

    return {
        "CUR": Role(at("competencia"), "canal <> '' AND competencia IS NOT NULL"),
        "NEXT": Role(at("add_months(competencia, 1)")),
        "CHURN": Role(at("mes_churn")),
    }


def bd_planos_periodicos(
    plans: DataFrame,
    bounded: bool = False,
    separate_ids: bool = False,
    metrics: bool = True,
    day: date | None = None,
    at_rest: bool = False,
) -> DataFrame:
    """Plan waterfall by channel, team, region, month and size.

    Contracts are counted by account and contract id joined without a separator, as the source
    report does, so (1, 23) and (12, 3) are one; ``separate_ids`` keeps them apart.
    """
    rows = plans_by_account(plans, bounded, day, at_rest).withColumn("mes_churn", F.col("mes_churn").cast("date"))
    joined = "concat(CAST(id_conta_olx AS STRING), CAST(id_contrato AS STRING))"
    source = Source(
        rows,
        _roles(),
        ["canal", "equipe_ajustada", "regionalizacao", "competencia", "tamanho", "mes_churn"],
        id="struct(id_conta_olx, id_contrato)" if separate_ids else joined,
        one_pass=metrics,
    )
    cells = Waterfall(DIMS, _metrics() if metrics else [], {"plans": source}).build()
    cells = cells.where(T.is_filled(F.col("Regiao_Macro")) & T.is_filled(F.col("Tamanho")))
    if not metrics:
        return cells
    key = T.join_key(*[F.col(d) for d in ("Canal", "Equipe", "Regiao_Macro", "Tamanho")])
    return cells.withColumn("chave_cruzamento", key)
