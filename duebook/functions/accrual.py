"""Unwinding and interest accruals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duebook.functions.daycount import year_fraction
from duebook.functions.flags import first_of_month


def daily_unwinding(
    gross: Column, provision: Column, rate: Column, start: Column, end: Column, basis: Column
) -> Column:
    """Interest a net exposure earns over one period at a yearly percentage."""
    net = F.greatest(gross - provision, F.lit(0))
    growth = F.pow(1 + rate / 100, year_fraction(start, end, basis)) - 1
    return net * growth


def month_to_date(day: Column, daily: Column, so_far: Column) -> Column:
    """Accrual since the first of the month; NULL amounts count as 0."""
    today = F.coalesce(daily, F.lit(0))
    return F.when(first_of_month(day), today).otherwise(today + F.coalesce(so_far, F.lit(0)))


def month_to_date_strict(day: Column, daily: Column, so_far: Column) -> Column:
    """The same, but a NULL amount makes the result NULL."""
    return F.when(first_of_month(day), daily).otherwise(so_far + daily)
