"""Extracts: accounts with a phased discount, and cohort dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata import schemas
from cascata.functions import dates as D
from cascata.functions import text as T
from cascata.sources import scans


def desconto_faseado(
    opportunity: DataFrame,
    account: DataFrame,
    user: DataFrame,
    gold: DataFrame,
    as_of: date,
    crm_day: tuple[int, int, int] | None = None,
    gold_day: date | None = None,
) -> DataFrame:
    """Discounted opportunities of accounts that are in the latest revenue snapshot.

    All three CRM tables are read at the newest year/month/day of the opportunities. The account
    ids are checked as a semi join, before the distinct. ``crm_day`` (year, month, day) and ``gold_day``
    name the newest partitions where they are known, so they are not looked for.
    """

    def at(df, schema):
        rows = schemas.complete(df, schema)
        if crm_day is None:
            return scans.at_day_number(rows, scans.newest_day_number(opportunity, as_of))
        return scans.at_day(rows, crm_day)

    c = F.col
    discount = c("discountrecurringvalue__c")
    deals = at(opportunity, schemas.OPPORTUNITY).where((discount != "0") & (discount != "0.0"))
    accounts = at(account, schemas.ACCOUNT).where(T.is_filled(c("idorigin__c"))).select(
        c("id").alias("__account"), c("idorigin__c").alias("advertiser_id"), c("name").alias("nome_conta")
    )
    users = at(user, schemas.USER).select(
        c("id").alias("__user"), c("name").alias("proprietario_oportunidade")
    )
    known = scans.snapshot(gold, gold_day).select("advertiser_id")
    accounts = accounts.join(known, "advertiser_id", "left_semi")
    return (
        deals.join(accounts, c("accountid") == c("__account"))
        .join(users, c("ownerid") == c("__user"), "left")
        .select(
            "advertiser_id",
            "nome_conta",
            c("lastmodifieddate").alias("data_ultima_mudanca_fase"),
            c("stagename").alias("fase"),
            c("amount").cast("double").alias("valor_total"),
            c("recurringtotalvalue__c").cast("double").alias("valor_mensal"),
            discount.cast("double").alias("promocao_desconto_3meses"),
            c("uniqueopportunityidentifier__c").alias("id_unico_oportunidade"),
            c("leadsource").alias("origem_lead"),
            c("generatedby__c").alias("gerado_por"),
            c("discountrecurringpercentage__c").cast("double").alias("pct_desconto"),
            "proprietario_oportunidade",
        )
        .distinct()
    )


def radar_cohort(radar: DataFrame, day: date | None = None) -> DataFrame:
    c = F.col
    return scans.snapshot(radar, day).where(c("base_date").isNotNull()).select(
        "advertiser_id",
        D.month_start(c("base_date")).alias("mes_base"),
        c("expiration_date").alias("data_vencimento_cohort"),
        c("payment_date").alias("data_pagamento_cohort"),
    )
