"""Rebuild only the months of the waterfalls that changed rows reach.

A revenue row is counted in the cell of its month, of the month after and of its cancellation month, so
a changed row touches these three. The cube (see ``grids.cube_of``) is stored by month: the partitions of
the changed rows' own months are rebuilt from the enriched rows, and the touched months of a waterfall from
the cube's rows that can reach them. All other partitions are neither read nor written.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata.operators.waterfall import Cube
from cascata.plans import grids
from cascata.sources import sinks, versions
from cascata.sources.scans import snapshot

Months = Sequence[date | None]
BASE, CANCELLED, CELL = "mes_base", "dt_cancelado", "Mes_Base"
SUMS, IDS = "receita_celulas", "receita_celulas_contas"


def changed_rows(old: DataFrame, new: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Rows of either side that the other lacks, repeats counted; of the given accounts only.

    A load names the accounts whose rows it brought, so both sides are narrowed before they are compared.
    A row's predecessor may have changed, so ``old`` and ``new`` are enriched rows.
    """
    if accounts is not None:
        ids = accounts.select("advertiser_id").distinct()
        old, new = (df.join(ids, "advertiser_id", "left_semi") for df in (old, new))
    # One grouping of both sides: the copies that one side has more.
    columns, copies = old.columns, F.abs(F.sum("__side"))
    sides = [df.select(*columns, F.lit(k).alias("__side")) for df, k in ((old, -1), (new, 1))]
    counted = sides[0].unionByName(sides[1]).groupBy(*columns).agg(copies.alias("__more")).where("__more <> 0")
    return counted.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "__more"))).drop("col")


def base_months(changed: DataFrame) -> list[date | None]:
    """The changed rows' own months; as many as there are months, whatever the number of rows."""
    return [r[0] for r in changed.select(BASE).distinct().collect()]


def cell_months(changed: DataFrame) -> list[date | None]:
    """Months of the cells in which changed rows count or counted."""
    reached = F.array(F.col(BASE), F.add_months(BASE, 1), F.col(CANCELLED))
    months = changed.select(F.explode(reached).alias("m")).distinct()
    return [r[0] for r in months.collect()]


def _in(column: Column, months: Months) -> Column:
    known = [m for m in months if m is not None]
    found = column.isin(known)
    return found | column.isNull() if None in months else found


def _reaching(rows: DataFrame, months: Months, base: str, gone: str) -> DataFrame:
    """Rows that can count in the months. The list of months before lets the scan skip partitions."""
    earlier = [None if m is None else _month_before(m) for m in months]
    return rows.where(_in(F.col(base), months) | _in(F.col(base), earlier) | _in(F.col(gone), months))


def _month_before(day: date) -> date:
    return date(day.year - (day.month == 1), (day.month - 2) % 12 + 1, day.day)


def store_cube(enriched: DataFrame, folder: str) -> Cube:
    """Write the cube, one partition a month of revenue, and read it back."""
    sinks.overwrite(grids.revenue_sums(enriched), f"{folder}/{SUMS}", BASE)
    sinks.overwrite(grids.revenue_ids(enriched), f"{folder}/{IDS}", BASE)
    return stored_cube(enriched.sparkSession, folder)


def stored_cube(spark: SparkSession, folder: str) -> Cube:
    return grids.cube_of(versions.read(spark, f"{folder}/{SUMS}"), versions.read(spark, f"{folder}/{IDS}"))


def refresh_cube(enriched: DataFrame, folder: str, months: Months) -> Cube:
    """Replace the cube's partitions of the given months of revenue."""
    rows = enriched.where(_in(F.col(BASE), months))
    sinks.replace_values(grids.revenue_sums(rows), f"{folder}/{SUMS}", BASE, months)
    sinks.replace_values(grids.revenue_ids(rows), f"{folder}/{IDS}", BASE, months)
    return stored_cube(enriched.sparkSession, folder)


def narrowed(cube: Cube, months: Months) -> Cube:
    """The cube's rows that can count in the months."""
    sums, ids = (_reaching(f, months, BASE, CANCELLED) for f in (cube.sums, cube.ids))
    return Cube(cube.parts, cube.name, cube.group, sums, ids)


def months_of(
    version: str,
    cube: Cube,
    payments: DataFrame,
    plans: DataFrame | None,
    months: Months,
    day: date | None = None,
) -> DataFrame:
    """The cells of the given months of one of the four waterfalls."""
    small = narrowed(cube, months)
    paid = payments.where(_in(F.try_to_date("mes_pago", "d/M/yyyy"), months))
    if version in (grids.UF, grids.SVA):
        build = grids.bd_planos_uf if version == grids.UF else grids.bd_planos_mensais_sva
        cells = build(None, paid, cube=small)
    else:
        build = grids.bd_full if version == grids.FULL else grids.bd_full_v2
        # The latest plans are found before rows are left out.
        cells = build(None, paid, _plans_reaching(snapshot(plans, day), months), cube=small, day=day)
    return cells.where(_in(F.col(CELL), months))


def _plans_reaching(plans: DataFrame, months: Months) -> DataFrame:
    """Plans that can count in the months: in their own, the next or that of their end."""
    own, gone = F.col("competencia").cast("date"), F.col("mes_churn").cast("date")
    return plans.where(_in(own, months) | _in(F.add_months(own, 1), months) | _in(gone, months))


def refresh_table(
    version: str,
    path: str,
    cube: Cube,
    payments: DataFrame,
    plans: DataFrame | None,
    months: Months,
    day: date | None = None,
) -> None:
    """Replace the given months of a waterfall that is stored by ``Mes_Base``."""
    sinks.replace_values(months_of(version, cube, payments, plans, months, day), path, CELL, months)
