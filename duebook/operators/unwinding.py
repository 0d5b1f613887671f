"""Unwinding of the discount on impaired exposures.

A row of the unwinding table is identified by working day, product group and
product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import CARD_GROUP
from duebook.functions.accrual import daily_unwinding, month_to_date
from duebook.functions.calendar import CloseDays
from duebook.operators import inputs
from duebook.operators.inputs import on_day
from duebook.plans.lookups import attach, attach_small, one_row_per_key
from duebook.plans.update import conform, replace_slice, update_where, with_surrogate_key
from duebook.schema import UNWINDING


def todays_cards(days: CloseDays) -> Column:
    return (F.col("product_group") == CARD_GROUP) & (F.col("working_day") == days.card_day)


def attach_unwinding(accounts, t22, t20, ecl, days: CloseDays) -> DataFrame:
    """As-of balance, its rate and the overwritten loss allowance."""
    columns = ("account_currency", "facility_id", "calculation_basis")
    df = inputs.attach_balances(accounts, t22, days.asof_day, columns, "asof_")
    df = attach_allowance(df, ecl)
    return attach_asof_rates(df, t20, days)


def attach_allowance(df: DataFrame, ecl: DataFrame) -> DataFrame:
    lookup = one_row_per_key(ecl, "id_product", ["overwritten_ecl"], "ecl_", repeats=False)
    return attach(df, lookup, "id_product", "ecl_key")


def attach_asof_rates(df: DataFrame, t20: DataFrame, days: CloseDays) -> DataFrame:
    return inputs.attach_rates(df, t20, days.asof_day, "asof_account_currency", "all_rate", "asoffx_")


def unwinding_rows(df: DataFrame, *more: str) -> DataFrame:
    """Today's rows for the unwinding table, from accounts that carry the lookups; ``more``
    of their columns are kept."""
    zero = F.lit(0).cast("decimal(22,2)")
    priced = df.filter(F.col("asof_found") & F.col("asoffx_found"))
    return priced.select(
        "working_day",
        "id_product",
        F.col("asof_facility_id").alias("facility_id"),
        "account_number",
        "p_working_day",
        F.col("working_day").alias("closing_day"),
        F.col("p_working_day").alias("p_closing_day"),
        F.lit(CARD_GROUP).alias("product_group"),
        F.col("retail_nonretail_indicator").alias("retail_nonretail"),
        (F.col("gca") * F.col("asoffx_all_rate")).alias("gca_all"),
        F.col("asof_calculation_basis").alias("calculation_basis"),
        F.col("standart_interest_rate").alias("interest_rate"),
        F.coalesce("ecl_overwritten_ecl", F.lit(0)).alias("provision_fund"),
        *[
            zero.alias(f"unwinding_{span}_{ccy}")
            for span, ccy in (("daily", "lcy"), ("mtd", "lcy"), ("daily", "ocy"), ("mtd", "ocy"))
        ],
        F.col("account_currency").alias("deal_ccy"),
        *more,
    )


def insert_unwinding(accounts, t22, t20, ecl, days: CloseDays) -> DataFrame:
    return unwinding_rows(attach_unwinding(accounts, t22, t20, ecl, days))


def as_stored(rows: DataFrame, history: DataFrame | int) -> DataFrame:
    """Rows with the columns and types of the unwinding table and new ids."""
    numbered = with_surrogate_key(conform(rows.drop("autoid"), UNWINDING), history)
    return numbered.select(*UNWINDING.names)


def with_todays_rows(t14: DataFrame, rows: DataFrame, days: CloseDays) -> DataFrame:
    """The unwinding table with today's card rows replaced; missing columns NULL."""
    return replace_slice(t14, todays_cards(days), rows)


def previous_month_to_date(t14: DataFrame, days: CloseDays) -> DataFrame:
    """Yesterday's month-to-date value by product, of any product group."""
    yesterday = on_day(t14, days.previous_day)
    return one_row_per_key(yesterday, "id_product", ["unwinding_mtd_lcy"], "prev_")


PREVIOUS = ("prev_found", "prev_unwinding_mtd_lcy")


def attach_previous(df: DataFrame, history: DataFrame, days: CloseDays) -> DataFrame:
    return attach(df, previous_month_to_date(history, days), "id_product", "prev_key")


def carry_unwinding_steps(df: DataFrame, days: CloseDays) -> DataFrame:
    hit = todays_cards(days) & F.col("prev_found")
    carried = update_where(df, hit, {"unwinding_mtd_lcy": F.col("prev_unwinding_mtd_lcy")})
    return carried.drop(*PREVIOUS)


def carry_unwinding(rows: DataFrame, history: DataFrame, days: CloseDays) -> DataFrame:
    """Today's card rows start from yesterday's month-to-date value.

    ``rows`` may be today's rows alone or the whole table; of ``history`` only
    the previous day is read.
    """
    return carry_unwinding_steps(attach_previous(rows, history, days), days)


def daily_unwinding_amounts(t14: DataFrame, days: CloseDays) -> DataFrame:
    amount = daily_unwinding(
        F.col("gca_all"),
        F.col("provision_fund"),
        F.col("interest_rate"),
        F.col("p_closing_day"),
        F.col("closing_day"),
        F.col("calculation_basis"),
    )
    return update_where(t14, todays_cards(days), {"unwinding_daily_lcy": amount})


def month_unwinding_amounts(t14: DataFrame, days: CloseDays) -> DataFrame:
    amount = month_to_date(
        F.col("working_day"), F.col("unwinding_daily_lcy"), F.col("unwinding_mtd_lcy")
    )
    return update_where(t14, todays_cards(days), {"unwinding_mtd_lcy": amount})


def original_currency_amounts(t14: DataFrame, t20: DataFrame, days: CloseDays) -> DataFrame:
    """Both amounts in the currency of the deal, NULL without a rate."""
    rates = one_row_per_key(on_day(t20, days.card_day), "currency", ["all_rate"], "fx_")
    df = attach_small(t14, rates, "deal_ccy", "fx_key")
    values = {
        f"unwinding_{span}_ocy": F.try_divide(F.col(f"unwinding_{span}_lcy"), F.col("fx_all_rate"))
        for span in ("daily", "mtd")
    }
    return update_where(df, todays_cards(days), values).drop("fx_found", "fx_all_rate")


def unwinding_amounts(rows, history, t20, days: CloseDays) -> DataFrame:
    """All amounts of today's rows."""
    return unwinding_amounts_steps(attach_previous(rows, history, days), t20, days)


def unwinding_amounts_steps(rows: DataFrame, t20: DataFrame, days: CloseDays) -> DataFrame:
    """All amounts of today's rows that carry yesterday's value."""
    df = daily_unwinding_amounts(carry_unwinding_steps(rows, days), days)
    return original_currency_amounts(month_unwinding_amounts(df, days), t20, days)
