"""Month arithmetic, day/month/year text and business-day cutoffs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIAL_ORIGIN = "1899-12-30"  # fixed value: day 0 of spreadsheet serial dates


def shift_months(c: Column, months: int) -> Column:
    """Same day in another month, clamped to that month's end."""
    return F.add_months(c, months)


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def read_date(c: Column) -> Column:
    """Day/month/year text first, then whatever casts to a date, else null."""
    text = c.cast("string")
    return F.coalesce(F.try_to_date(text, "d/M/yyyy"), text.try_cast("date"))


def show_date(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def serial_day(c: Column) -> Column:
    return F.datediff(c, F.lit(SERIAL_ORIGIN).cast("date"))


def same_month(a: Column, b: Column) -> Column:
    return (F.month(a) == F.month(b)) & (F.year(a) == F.year(b))


def last_weekdays(month: Column, n: int, lookback: int = 15) -> Column:
    """The last ``n`` weekdays of the month, newest first, as an array of dates."""
    end = F.last_day(month)
    days = F.sequence(F.date_sub(end, lookback), end)
    weekdays = F.filter(days, lambda d: ~F.dayofweek(d).isin(1, 7))
    return F.slice(F.reverse(weekdays), 1, n)


def weekday_cutoff(month: Column, n: int) -> Column:
    """First of the last ``n`` weekdays of the month, by arithmetic on the last weekday.

    Going back ``n - 1`` weekdays from a weekday crosses one weekend per started week.
    """
    end = F.last_day(month)
    dow = F.weekday(end)  # Monday = 0
    last_weekday = F.date_sub(end, F.greatest(dow - 4, F.lit(0)))
    w = F.least(dow, F.lit(4))
    back = n - 1
    weekends = F.greatest(F.ceil((F.lit(back) - w) / F.lit(5)), F.lit(0))
    return F.date_sub(last_weekday, (F.lit(back) + 2 * weekends).cast("int"))


def in_last_days(day: Column, month: Column, n: int) -> Column:
    """Day falls in the last ``n`` calendar days of the month."""
    end = F.last_day(month)
    return (day >= F.date_sub(F.date_add(end, 1), n)) & (day <= end)
