"""Business columns of the revenue model (regions, size bands, teams, flags).

``*_of`` variants and ``number=`` take columns that are cleaned already. Table builders put the
cleaned columns in a projection of their own, so each is computed once per row and not once per
branch of a CASE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cascata.functions import dates as D
from cascata.functions import text as T

# State codes of each macro region, and the size bands of a package.
REGION_STATES = {
    "Sul": ("RS", "SC", "PR"),
    "MG/ES": ("MG", "ES"),
    "RJ": ("RJ",),
    "NO/CO": ("MS", "MT", "GO", "DF", "TO", "PA", "AP", "RO", "AC", "AM"),
    "NE": ("BA", "PI", "MA", "CE", "RN", "PB", "PE", "AL", "SE"),
}
CAPITAL_STATE = "SP"
CAPITAL_CITY = "SÃO PAULO"
CAPITAL = "Sp Capital"
CAPITAL_REST = "SP Interior & Litoral"
OTHER_REGION = "Outros"
SIZE_LIMITS = (("PP", 25), ("P", 80), ("M", 600))
SIZE_ABOVE = "G"
YES, NO, MIGRATED = "Sim", "Não", "Migrado"
NEW, UP, DOWN = "Novo", "Upgrade", "Downgrade"
CHURN, RECOVERED = "CHURN", "CHURN - Recuperado"
PAID_STATUS = "1-Paid"
PAYMENT_REGION_ALIASES = {"RJ+MG+ES": "RJ", "N+NE+CO": "NE"}


def region(state: Column, city: Column) -> Column:
    return region_of(T.clean_upper(state), T.clean_upper(city))


def region_of(code: Column, city: Column) -> Column:
    """Region of an already cleaned state code and city name."""
    out = F.when(F.coalesce(code, F.lit("")) == "", "")
    for name, states in REGION_STATES.items():
        out = out.when(code.isin(*states), name)
    capital = (code == CAPITAL_STATE) & F.coalesce(city == CAPITAL_CITY, F.lit(False))
    return out.when(capital, CAPITAL).when(code == CAPITAL_STATE, CAPITAL_REST).otherwise(OTHER_REGION)


def size_band(number: Column) -> Column:
    """Band of a package's number; null for no number."""
    out = F.when(number.isNull(), None)
    for band, limit in SIZE_LIMITS:
        out = out.when(number <= limit, band)
    return out.otherwise(SIZE_ABOVE)


def adjusted_size(package: Column, size: Column, number: Column | None = None) -> Column:
    number = T.first_number(package) if number is None else number
    banded = F.coalesce(size_band(number), size, F.lit(""))
    return F.when(T.mentions(package, "inser"), F.coalesce(size, package)).otherwise(banded)


def official_size(package: Column, null_as: str | None = None, number: Column | None = None) -> Column:
    number = T.first_number(package) if number is None else number
    return F.coalesce(size_band(number), F.lit(null_as))


def fold_smallest(size: Column) -> Column:
    """PP counts as P."""
    return F.when(size == "PP", "P").otherwise(size)


def team(channel: Column, coordinator: Column, online: str, nd: str) -> Column:
    """Clean coordinator name, with fixed names for the two channels without a team.

    Channels are matched whatever their case and outer blanks.
    """
    return team_of(T.clean_upper(channel), T.clean_upper(coordinator), online, nd)


def team_of(channel: Column, coordinator: Column, online: str, nd: str) -> Column:
    """Team of already cleaned names."""
    named = F.coalesce(coordinator, F.lit(""))
    return F.when(channel == "ONLINE", online).when(channel == "ND", nd).otherwise(named)


def payment_team(channel: Column, coordinator: Column) -> Column:
    """Payment variant: only the exact spellings 'Online' and 'ND' are kept."""
    return F.when(channel.isin("Online", "ND"), channel).otherwise(
        F.coalesce(T.clean_upper(coordinator), F.lit(""))
    )


def payment_coordinator(channel: Column, coordinator: Column) -> Column:
    return F.coalesce(F.nullif(coordinator, F.lit("")), channel)


def moved(classification: Column, previous: Column, current: Column) -> Column:
    """Changed channel and is not new. Null inputs never count as moved."""
    return F.coalesce((classification != NEW) & (previous != current), F.lit(False))


def migrated_label(is_moved: Column) -> Column:
    return F.when(is_moved, MIGRATED)


def team_before(is_moved: Column, channel: Column, coordinator: Column) -> Column:
    """Team the account left: fixed names for teamless channels, else the raw name."""
    return F.when(is_moved, F.when(channel.isin("Online", "ND"), channel).otherwise(coordinator))


def yes_no(flag: Column) -> Column:
    return F.when(flag, YES).otherwise(NO)


def nonzero(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def one_if_paid(advertiser: Column, *amounts: Column) -> Column:
    paid = nonzero(amounts[0])
    for amount in amounts[1:]:
        paid = paid | nonzero(amount)
    return F.when(advertiser.isNotNull() & paid, 1)


def delta_class(delta: Column) -> Column:
    return F.when(delta > 0, UP).when(delta < 0, DOWN)


def size_status(current: Column, previous: Column) -> Column:
    return F.when(previous.isNull(), "Novo").when(current == previous, "OK").otherwise("Mudou")


def dated_key(identifier: Column, day: Column) -> Column:
    """Identifier and ISO date in one text."""
    return T.join_key(identifier, day)


def serial_key(identifier: Column, day: Column) -> Column:
    """Identifier and spreadsheet serial of the date in one text."""
    return T.join_key(identifier, D.serial_day(D.read_date(day)))


def payment_region(c: Column) -> Column:
    out = T.strip(c)
    for alias, name in PAYMENT_REGION_ALIASES.items():
        out = F.when(c == alias, name).otherwise(out)
    return out


def not_cancelled_in_month(cancelled: Column, month: Column) -> Column:
    return cancelled.isNull() | ~D.same_month(cancelled, month)


def elapsed_volume(
    day: Column, month: Column, cohort_paid: Column, cancelled: Column, amount: Column
) -> Column:
    """Amount of accounts signed in the month's last six weekdays.

    The cohort payment must be unknown or fall in the next month; only the month number
    is compared there, the year is not.
    """
    late = (day >= D.weekday_cutoff(month, 6)) & (day <= F.last_day(month))
    paid_next = cohort_paid.isNull() | (F.month(cohort_paid) == F.month(D.shift_months(month, 1)))
    return F.when(late & paid_next & not_cancelled_in_month(cancelled, month), amount).otherwise(
        F.lit(0)
    )
