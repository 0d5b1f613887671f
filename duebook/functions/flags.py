"""Typed reading of loosely typed columns.

Indicators arrive as text or numbers depending on who wrote them last.  They
are compared as text, so results do not depend on the ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_one(name: str) -> Column:
    return F.col(name).cast("string") == "1"


def is_zero(name: str) -> Column:
    return F.col(name).cast("string") == "0"


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def turned_on(name: str) -> Column:
    """0 yesterday, 1 today."""
    return is_zero(f"p_{name}") & is_one(name)


def stayed_on(name: str) -> Column:
    return is_one(f"p_{name}") & is_one(name)


def turned_off(name: str) -> Column:
    return is_one(f"p_{name}") & is_zero(name)


def day_number(date: Column) -> Column:
    """A date as the integer yyyyMMdd."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def from_day_number(number: Column) -> Column:
    """The date of an integer yyyyMMdd; NULL where it is not a date."""
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def first_of_month(date: Column) -> Column:
    return F.dayofmonth(date) == 1
