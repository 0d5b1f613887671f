import datetime as dt

import pytest
from pyspark.sql import functions as F

from duebook.functions.accrual import month_to_date, month_to_date_strict
from duebook.functions.calendar import CloseDays
from duebook.functions.daycount import year_fraction
from duebook.functions.flags import day_number, from_day_number
from duebook.functions.reasons import distinct_reasons


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "start, end, basis, expected",
    [
        ("2024-01-31", "2024-02-29", 1, 0.079452055),
        ("2024-01-31", "2024-02-29", 2, 0.080555556),
        ("2024-01-31", "2024-02-29", 3, 0.080555556),
        ("2024-01-31", "2024-02-29", 6, 0.079234973),
        ("2024-01-30", "2024-02-01", 3, 0.002777778),
        ("2024-01-15", "2024-02-01", 7, 0.044444444),
        ("2024-01-15", "2024-02-01", 8, 0.0),
        ("2024-01-15", "2024-02-01", None, 0.0),
    ],
)
def test_year_fraction(spark, start, end, basis, expected):
    fraction = year_fraction(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.lit(basis).cast("int")
    )
    assert value(spark, fraction) == pytest.approx(expected, abs=1e-12)


def test_month_to_date(spark):
    first, second = F.lit("2024-02-01").cast("date"), F.lit("2024-02-02").cast("date")
    nothing = F.lit(None).cast("double")
    assert value(spark, month_to_date(first, F.lit(2.0), F.lit(5.0))) == 2.0
    assert value(spark, month_to_date(second, F.lit(2.0), F.lit(5.0))) == 7.0
    assert value(spark, month_to_date(second, F.lit(2.0), nothing)) == 2.0
    assert value(spark, month_to_date_strict(second, F.lit(2.0), nothing)) is None


def test_reasons_keep_their_order(spark):
    assert value(spark, distinct_reasons(F.lit(",DPD,,DPD,A"))) == ",DPD,A"


def test_day_numbers(spark):
    day = dt.date(2024, 2, 29)
    assert value(spark, day_number(F.lit(day))) == 20240229
    assert value(spark, from_day_number(F.lit(20240229))) == day
    assert value(spark, from_day_number(F.lit(20230229))) is None


def test_close_days(spark):
    days = [dt.date(2024, 1, d) for d in (26, 29, 30)]
    card = spark.createDataFrame([(d,) for d in days], "working_day date")
    bank = spark.createDataFrame([(d,) for d in (days[0], days[1], dt.date(2024, 2, 2))], "working_day date")
    lazy = CloseDays.from_calendars(bank, card)
    for close in (lazy, lazy.resolved(spark)):
        assert value(spark, close.card_day) == days[2]
        assert value(spark, close.bank_day) == dt.date(2024, 2, 2)
        assert value(spark, close.asof_day) == days[1]
        assert value(spark, close.previous_day) == days[1]
        assert value(spark, close.next_month) == dt.date(2024, 2, 29)
