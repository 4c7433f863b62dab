"""Account-month revenue: consolidation, enrichment, transfers and size changes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascata import schemas
from cascata.functions import business as B
from cascata.functions import text as T
from cascata.operators.lookups import add_member_flag, keys_of_both
from cascata.operators.ordered import add_previous
from cascata.sources.scans import one_snapshot

FIELD = "Field"


def receita_consolidada(gold: DataFrame, silver: DataFrame, snapshot: date | None = None) -> DataFrame:
    """Both revenue sources in one shape, tagged with their origin; all days or those of one ``snapshot``."""
    gold, silver = one_snapshot(gold, snapshot), one_snapshot(silver, snapshot)
    shared = ("advertiser_id", "mes_base", "canal_conta")
    tail = ("estado", "tamanho", "classificacao")
    unified = gold.select(
        "dt", F.lit("receita_unificada").alias("fonte"), *shared, "cordenador", *tail,
        "faturado_mes", "status_ts",
    )
    cb = silver.select(
        "dt", F.lit("receita_cb").alias("fonte"), *shared, F.col("dono_conta").alias("cordenador"),
        *tail, F.col("pago_mes").alias("faturado_mes"), "status_ts",
    )
    return unified.unionByName(cb)


def receita_enriquecida(
    gold: DataFrame,
    discounts: DataFrame,
    cohorts: DataFrame,
    unique_months: bool = False,
    transfer_list: DataFrame | None = None,
    size_overrides: DataFrame | None = None,
    snapshot: date | None = None,
) -> DataFrame:
    """Revenue rows with region, size, team, migration, discount and cohort columns.

    ``unique_months`` states that a gold account has at most one row per month. Then lag and
    transfer flags share one shuffle by account; else hot accounts are split. ``transfer_list``
    replaces the transfers found in the data, ``size_overrides`` (advertiser_id, tamanho) the
    size of packages that name no number. ``snapshot`` takes the gold rows of one day; without it several
    snapshots of an account-month follow one another.
    """
    base = schemas.complete(one_snapshot(gold, snapshot), schemas.GOLD).select(*schemas.GOLD.fieldNames())
    rows = add_previous(
        base,
        ["advertiser_id"],
        ["mes_base"],
        {"aux_canal_out": "canal_conta", "aux_coord_out": "cordenador"},
        bounded=unique_months,
    )
    rows = _with_transfer_flag(rows, base, unique_months, transfer_list)
    rows = add_member_flag(rows, "advertiser_id", discounts, "__discount")
    rows = rows.join(
        cohorts.select("advertiser_id", "mes_base", "data_vencimento_cohort", "data_pagamento_cohort"),
        ["advertiser_id", "mes_base"],
        "left",
    )
    size = F.col("tamanho")
    if size_overrides is not None:
        listed = size_overrides.select("advertiser_id", F.col("tamanho").alias("__size"))
        rows = rows.join(listed, "advertiser_id", "left")
        size = F.coalesce(F.col("__size"), size)
    c = F.col
    rows = rows.withColumns(
        {
            "__state": T.clean_upper(c("estado")),
            "__city": T.clean_upper(c("municipio")),
            "__channel": T.clean_upper(c("canal_conta")),
            "__number": T.first_number(c("pacote")),
            "__moved": B.moved(c("classificacao"), c("aux_canal_out"), c("canal_conta")),
        }
    )
    is_moved = c("__moved")
    return rows.select(
        *schemas.GOLD.fieldNames(),
        B.region_of(c("__state"), c("__city")).alias("regionalizacao"),
        B.one_if_paid(c("advertiser_id"), c("pago_mes_campanha")).alias("apoio_qtd_campanha"),
        B.one_if_paid(c("advertiser_id"), c("pago_mes_topo"), c("pago_mes_bairro")).alias(
            "apoio_qtd_sva"
        ),
        B.dated_key(c("advertiser_id"), c("mes_base")).alias("id_e_data"),
        B.dated_key(c("advertiser_id"), c("ultimo_mes_pagamento")).alias("id_ajustado"),
        T.first_digits(c("pacote")).alias("tamanho_nr"),
        B.adjusted_size(c("pacote"), size, c("__number")).alias("tamanho_ajustado"),
        B.team_of(c("__channel"), T.clean_upper(c("cordenador")), "ONLINE", "ND").alias(
            "coordenador_ajustado"
        ),
        B.migrated_label(is_moved).alias("status_migrado"),
        "aux_canal_out",
        "aux_coord_out",
        B.team_before(is_moved, c("aux_canal_out"), c("aux_coord_out")).alias(
            "coordenador_ajustado_out"
        ),
        B.dated_key(c("advertiser_id"), c("dt_cancelado")).alias("chave_churn"),
        B.yes_no((c("canal_conta") == FIELD) & c("__transfer")).alias("id_migracao_pro_field"),
        B.yes_no(c("__discount")).alias("desconto_faseado"),
        "data_vencimento_cohort",
        "data_pagamento_cohort",
        B.elapsed_volume(
            c("day_base"), c("mes_base"), c("data_pagamento_cohort"), c("dt_cancelado"),
            c("faturado_mes"),
        ).alias("volume_transcorrido"),
    )


def _with_transfer_flag(rows, base, unique_months, transfer_list):
    """Account has a non-new row in Field and a row in another channel."""
    in_field = (F.col("canal_conta") == FIELD) & (F.col("classificacao") != B.NEW)
    elsewhere = F.col("canal_conta") != FIELD
    if transfer_list is not None:
        return add_member_flag(rows, "advertiser_id", transfer_list, "__transfer")
    if not unique_months:
        members = keys_of_both(base, "advertiser_id", in_field, elsewhere)
        return add_member_flag(rows, "advertiser_id", members, "__transfer")
    account = Window.partitionBy("advertiser_id")
    both = F.bool_or(in_field).over(account) & F.bool_or(elsewhere).over(account)
    known = F.col("advertiser_id").isNotNull()
    return rows.withColumn("__transfer", F.coalesce(known & both, F.lit(False)))


def transferencias(enriched: DataFrame) -> DataFrame:
    """Rows that migrated into Field."""
    hits = (F.col("status_migrado") == B.MIGRATED) & (F.col("canal_conta") == FIELD)
    return enriched.where(hits).select(
        "advertiser_id", "mes_base", F.col("tamanho_ajustado").alias("tamanho"), "canal_conta",
        "status_migrado", "aux_canal_out",
    )


def tamanhos_ajustados(enriched: DataFrame, unique_months: bool = False) -> DataFrame:
    """Size now against the month before, for rows that have a month before with a size."""
    sizes = enriched.select(
        "advertiser_id", "mes_base", F.col("tamanho_ajustado").alias("tamanho_atual")
    )
    lagged = add_previous(
        sizes, ["advertiser_id"], ["mes_base"], {"tamanho_mes_anterior": "tamanho_atual"},
        bounded=unique_months,
    )
    status = B.size_status(F.col("tamanho_atual"), F.col("tamanho_mes_anterior"))
    return lagged.where(F.col("tamanho_mes_anterior").isNotNull()).withColumns(
        {"status_tamanho": status, "tamanho_correto_sugerido": F.col("tamanho_atual")}
    )
