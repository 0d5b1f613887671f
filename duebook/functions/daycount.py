"""Day-count fractions between two dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calculation basis -> days in the year; the rest are 30/360.
ACTUAL_YEARS = {1: 365, 2: 360, 4: 365, 5: 360, 6: 366}
THIRTY_360 = (3, 7)


def year_fraction(start: Column, end: Column, basis: Column) -> Column:
    """Fraction of a year from ``start`` to ``end``, to nine decimals.

    Actual-day bases divide the days between by their year length.  The 30/360
    bases count months as 30 days with day 31 read as 30, except that a period
    from inside a 31-day month to the first of a month counts actual days from
    the day after its start.  Any other basis gives 0.
    """
    days = F.datediff(end, start)
    cap = lambda date: F.least(F.dayofmonth(date), F.lit(30))
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    into_first = (
        (F.dayofmonth(end) == 1)
        & (F.dayofmonth(start) < 31)
        & (F.dayofmonth(F.last_day(start)) == 31)
    )
    bond = F.when(into_first, days - 1).otherwise(months * 30 + cap(end) - cap(start))

    fraction = F.when(basis.isin(*THIRTY_360), bond / F.lit(360.0))
    for code, year in ACTUAL_YEARS.items():
        fraction = fraction.when(basis == code, days / F.lit(float(year)))
    return F.round(fraction.otherwise(F.lit(0.0)), 9)
