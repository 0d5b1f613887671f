"""The days a close refers to, taken from the two working-day calendars."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "working_day"


def latest_day(calendar: DataFrame) -> DataFrame:
    """One row: the last day of a calendar."""
    return calendar.agg(F.max(DAY).alias(DAY))


def latest_day_until(calendar: DataFrame, day: Column) -> DataFrame:
    """One row: the last day of a calendar on or before ``day``."""
    return latest_day(calendar.filter(F.col(DAY) <= day))


def latest_day_before(calendar: DataFrame, day: Column) -> DataFrame:
    """One row: the last day of a calendar strictly before ``day``."""
    return latest_day(calendar.filter(F.col(DAY) < day))


@dataclass(frozen=True)
class CloseDays:
    """Days of one close, each usable in any expression.

    Built from calendars they are scalar subqueries: Spark works out the day
    once, before the scan that filters on it, so a table partitioned by day
    still reads one partition and nothing is fetched to the driver.
    """

    card_day: Column  # last day of the card calendar
    bank_day: Column  # last day of the bank calendar
    asof_day: Column  # last bank day not after the card day
    previous_day: Column  # last card day before the card day

    @classmethod
    def from_calendars(cls, bank: DataFrame, card: DataFrame) -> CloseDays:
        card_day = latest_day(card).scalar()
        return cls(
            card_day=card_day,
            bank_day=latest_day(bank).scalar(),
            asof_day=latest_day_until(bank, card_day).scalar(),
            previous_day=latest_day_before(card, card_day).scalar(),
        )

    @classmethod
    def of(cls, card_day, bank_day=None, asof_day=None, previous_day=None) -> CloseDays:
        """Known days, as plain values: partition filters are then static."""
        bank = card_day if bank_day is None else bank_day
        asof = min(bank, card_day) if asof_day is None else asof_day
        return cls(F.lit(card_day), F.lit(bank), F.lit(asof), F.lit(previous_day))

    def dates(self, spark: SparkSession) -> tuple:
        """Card, bank, as-of and previous day, read as one row."""
        row = spark.range(1).select(
            self.card_day.alias("card"),
            self.bank_day.alias("bank"),
            self.asof_day.alias("asof"),
            self.previous_day.alias("previous"),
        ).first()
        return tuple(row)

    def resolved(self, spark: SparkSession) -> CloseDays:
        """The same days as plain values.

        A long chain of steps that names the days often is then planned faster,
        and day partitions are chosen when the query is planned.
        """
        return CloseDays(*[F.lit(value) for value in self.dates(spark)])

    @property
    def next_day(self) -> Column:
        return F.date_add(self.card_day, 1)

    @property
    def next_month(self) -> Column:
        return F.add_months(self.card_day, 1)
