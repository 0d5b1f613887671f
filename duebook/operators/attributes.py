"""Attributes of a default: history flag, amount, dates, id and interest rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import NONRETAIL, OBSERVED, RETAIL, check_mode
from duebook.functions.flags import (
    day_number,
    is_one,
    is_zero,
    stayed_on,
    turned_off,
    turned_on,
    zero_if_null,
)
from duebook.operators import inputs
from duebook.operators.delinquency import is_segment
from duebook.plans.lookups import HotKeys

ATTRIBUTES = (
    "historical_default_indicator",
    "default_amount",
    "default_start_date",
    "default_end_date",
    "default_id",
    "interest_rate_default",
)


def _eve() -> Column:
    """The day before the working day, as a number."""
    return day_number(F.date_sub(F.col("working_day"), 1))


def historical_indicator() -> Column:
    before = F.col("p_historical_default_indicator")
    first = (before == "0") & is_one("default_indicator")
    return F.when(first, "1").otherwise(F.coalesce(before, F.lit("0")))


def default_amount() -> Column:
    ledger = F.col("bal_ledger_balance")
    return (
        F.when(turned_on("default_indicator"), F.when(ledger <= 0, F.abs(ledger)).otherwise(0))
        .when(stayed_on("default_indicator"), zero_if_null("p_default_amount"))
        .otherwise(0)
    )


def default_start() -> Column:
    return F.when(turned_on("default_indicator"), _eve()).when(
        stayed_on("default_indicator"), F.coalesce(F.col("p_default_start_date"), _eve())
    )


def default_end() -> Column:
    return F.when(turned_off("default_indicator"), _eve()).otherwise(F.col("p_default_end_date"))


def default_id(start: Column) -> Column:
    fresh = F.concat("customer_number", "id_product", start.cast("string"))
    return F.when(turned_on("default_indicator"), fresh).when(
        ~F.coalesce(is_zero("default_indicator"), F.lit(False)),
        F.coalesce(F.col("default_id"), fresh),
    )


def default_rate() -> Column:
    standard = F.col("standart_interest_rate")
    return (
        F.when(turned_on("default_indicator"), standard)
        .when(is_zero("default_indicator"), F.lit(0))
        .otherwise(F.coalesce(F.col("interest_rate_default"), standard))
    )


def default_attributes_steps(df: DataFrame, mode: str = OBSERVED) -> DataFrame:
    """All attributes at once.

    Observed: nonretail accounts keep what they had.  Intended: theirs are set
    too, with the start date of the customer.
    """
    observed = check_mode(mode)
    start = default_start()
    if not observed:
        of_customer = day_number(F.col("cust_default_start_date"))
        start = F.when(is_segment(NONRETAIL), of_customer).otherwise(start)
    df = df.withColumn("_start", start.cast("int"))
    values = {
        "historical_default_indicator": historical_indicator(),
        "default_amount": default_amount(),
        "default_start_date": F.col("_start"),
        "default_end_date": default_end(),
        "default_id": default_id(F.col("_start")),
        "interest_rate_default": default_rate(),
    }
    types = dict(df.dtypes)
    changed = is_segment(RETAIL) if observed else F.lit(True)
    return df.withColumns(
        {
            name: F.when(changed, value.cast(types.get(name, "string"))).otherwise(F.col(name))
            for name, value in values.items()
        }
    ).drop("_start")


def default_attributes(
    accounts: DataFrame, t22, customers, days, mode: str = OBSERVED, hot: HotKeys | None = None
) -> DataFrame:
    df = inputs.attach_balances(accounts, t22, days.bank_day, ["ledger_balance"])
    if not check_mode(mode):
        df = inputs.attach_customers(df, customers, columns=["default_start_date"], hot=hot)
    return default_attributes_steps(df, mode).select(*accounts.columns)
