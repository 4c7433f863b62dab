"""Payments with the account's channel, team, region and size at payment time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.functions import business as B
from cascata.functions import dates as D
from cascata.functions import text as T
from cascata.operators.lookups import add_member_flag, exact_or_latest
from cascata.operators.ordered import add_previous, first_per
from cascata.sources.scans import one_snapshot
from cascata.sources.scans import snapshot as scans_snapshot

TRANSFER_SINCE = date(2025, 12, 1)  # fixed value: start of the transfer history
AMOUNTS = ("antecipado", "no_mes", "transcorrido")
NUMERIC = "decimal(38,9)"


def account_history(gold: DataFrame, unique_months: bool = False) -> DataFrame:
    """Dimensions of an account per month; the first month counts as coming from 'inicio'."""
    rows = gold.select(
        "advertiser_id", "mes_base", "canal_conta", "cordenador", "estado", "tamanho", "municipio",
        "classificacao",
    )
    rows = add_previous(
        rows, ["advertiser_id"], ["mes_base"],
        {"__channel": "canal_conta", "__coordinator": "cordenador"},
        default="inicio", bounded=unique_months,
    )
    c = F.col
    rows = rows.withColumns(
        {
            "__state": T.clean_upper(c("estado")),
            "__city": T.clean_upper(c("municipio")),
            "__moved": B.moved(c("classificacao"), c("__channel"), c("canal_conta")),
        }
    )
    is_moved = c("__moved")
    return rows.select(
        "advertiser_id", "mes_base", "canal_conta", "cordenador", "estado", "tamanho",
        B.region_of(c("__state"), c("__city")).alias("regionalizacao"),
        B.migrated_label(is_moved).alias("status_migrado"),
        F.when(is_moved, c("__channel")).alias("aux_canal_out"),
        F.when(is_moved, c("__coordinator")).alias("aux_coord_out"),
    )


def _moved_to_field(since: date):
    moved_in = (F.col("status_migrado") == B.MIGRATED) & (F.col("canal_conta") == "Field")
    return moved_in & (F.col("mes_base") >= F.lit(since))


def moved_to_field(history: DataFrame, since: date = TRANSFER_SINCE) -> DataFrame:
    return history.where(_moved_to_field(since)).select("advertiser_id").distinct()


def account_facts(history: DataFrame, months: Sequence[date], since: date) -> DataFrame:
    """Per account the latest row, the row of each given month and the transfer mark.

    One aggregate over the history. After the bounded lag it needs no shuffle of its own.
    """
    row = F.struct(*[c for c in history.columns if c not in ("advertiser_id", "mes_base")])
    at = [F.max_by(row, F.when(F.col("mes_base") == F.lit(m), row)) for m in months]
    return (
        history.where(F.col("advertiser_id").isNotNull())
        .groupBy("advertiser_id")
        .agg(
            F.max_by(row, F.struct("mes_base", row)).alias("__latest"),
            F.coalesce(F.bool_or(_moved_to_field(since)), F.lit(False)).alias("__listed"),
            *[a.alias(f"__at_{k}") for k, a in enumerate(at)],
        )
    )


def payment_months(as_of: date) -> list[date]:
    """This month and the one before."""
    first = as_of.replace(day=1)
    before = date(first.year - (first.month == 1), (first.month - 2) % 12 + 1, 1)
    return [first, before]


def cb_pagamentos(
    gold: DataFrame,
    payments: DataFrame,
    as_of: date,
    transfer_since: date = TRANSFER_SINCE,
    months: Sequence[date] | None = None,
    all_months: bool = False,
    per_payment: bool = False,
    unique_months: bool = False,
    snapshot: date | None = None,
    paid_day: date | None = None,
) -> DataFrame:
    """One row per account and paid month of the latest snapshot.

    ``paid_day`` names that snapshot where it is known, so it is not looked for; ``snapshot`` takes the
    gold rows of one day.

    Only the months of ``payment_months`` are kept unless ``months`` or ``all_months`` say
    otherwise. Several payments of one account-month collapse to the first in column order;
    ``per_payment`` keeps them all.
    """
    history = account_history(one_snapshot(gold, snapshot), unique_months)
    c = F.col
    paid = scans_snapshot(payments, paid_day).select(
        "advertiser_id", "mes_pago", "status_ts", *AMOUNTS, "day_paid", "dt"
    )
    kept = None if all_months else list(payment_months(as_of) if months is None else months)
    if kept is not None:
        paid = paid.where(c("mes_pago").isin(kept))
    if not per_payment:
        paid = first_per(paid, ["advertiser_id", "mes_pago"], F.lit(0))
    if kept is None:
        rows = exact_or_latest(paid, history, "advertiser_id", "mes_pago", "mes_base")
        listed = moved_to_field(history, transfer_since)
        rows = add_member_flag(rows, "advertiser_id", listed, "__listed")
    else:
        facts = account_facts(history, kept, transfer_since)
        joined = paid.join(facts, "advertiser_id", "left")
        exact = [F.when(c("mes_pago") == F.lit(m), c(f"__at_{k}")) for k, m in enumerate(kept)]
        chosen = F.coalesce(*exact, c("__latest"))
        rows = joined.withColumn("__listed", F.coalesce("__listed", F.lit(False))).select(
            *paid.columns, "__listed", chosen.alias("__row")
        ).select(*paid.columns, "__listed", "__row.*")
    text_date = lambda name: D.show_date(D.read_date(c(name))).alias(name)
    filled = [F.coalesce(c(a), F.lit(0)) for a in AMOUNTS]
    channel, coordinator = c("canal_conta"), c("cordenador")
    return rows.select(
        "advertiser_id",
        text_date("mes_pago"),
        text_date("day_paid"),
        "status_ts",
        *[v.cast(NUMERIC).alias(a) for a, v in zip(AMOUNTS, filled)],
        (filled[0] + filled[1] + filled[2]).cast(NUMERIC).alias("pago_mes"),
        text_date("dt"),
        B.payment_coordinator(channel, coordinator).alias("coordenador"),
        channel.alias("canal"),
        B.serial_key(c("advertiser_id"), c("mes_pago")).alias("id_e_data"),
        "regionalizacao",
        c("estado").alias("uf"),
        "tamanho",
        F.coalesce(c("status_migrado"), F.lit(B.NO)).alias("status_migrado"),
        B.yes_no((channel == "Field") & c("__listed")).alias("id_migracao_pro_field"),
        B.payment_team(channel, coordinator).alias("coordenador_ajustado"),
        "aux_canal_out",
        "aux_coord_out",
    )
