"""Named checks: a frame builder and, where SQL can say it, the text that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cascata.plans import crm, payments, revenue
from cascata.sources import sinks
from checks import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Inputs:
    """Tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._kept: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return X.table(self.spark, self.folder, name)

    def view(self, name: str) -> DataFrame:
        return X.view(self.spark, self.folder, name)

    @property
    def gold(self) -> DataFrame:
        return self.view("gold")

    def kept(self, name: str) -> DataFrame:
        """A view stored once, as source tables are: each further reader scans it and joins nothing anew."""
        if name not in self._kept:
            self._kept[name] = sinks.stored(self.view(name))
        return self._kept[name]

    def discounts(self, gold: DataFrame | None = None) -> DataFrame:
        gold = self.gold if gold is None else gold
        return crm.desconto_faseado(
            self.view("opportunity"), self.view("account"), self.view("crm_user"), gold, X.AS_OF
        )

    def cohorts(self) -> DataFrame:
        return crm.radar_cohort(self.view("radar"))

    def enriched(self, unique_months: bool = True) -> DataFrame:
        """The gold view groups by account and month, so months are unique per account."""
        gold = self.kept("gold")
        return revenue.receita_enriquecida(
            gold, self.discounts(gold), self.cohorts(), unique_months=unique_months
        )

    def stored_enriched(self) -> DataFrame:
        """Enriched rows as the chain hands them on, for tables that read them more than once."""
        return sinks.stored(self.enriched())

    def payments(self, unique_months: bool = True, **options) -> DataFrame:
        """Payments of all months read gold several times, those of two months once."""
        gold = self.kept("gold") if options.get("all_months") else self._kept.get("gold", self.gold)
        return payments.cb_pagamentos(
            gold, self.view("paids"), X.AS_OF, X.TRANSFER_SINCE, unique_months=unique_months, **options
        )


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the numeric type of the report tables."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({n: F.col(n).cast("double") for n in decimals}) if decimals else df


def check(name: str, sql: str | None = None):
    """Register a query under ``name`` with its checking text."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain_numbers(build(Inputs(spark, folder)))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register
