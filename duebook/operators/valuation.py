"""Gross carrying amount and interest of the month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import EXCLUDED_ACCOUNT
from duebook.functions.accrual import month_to_date_strict
from duebook.functions.calendar import CloseDays
from duebook.operators.inputs import on_day


def carrying_amount(prefix: str = "asof_") -> Column:
    """Debt net of unamortised fees, not below 0; NULL without a balance row."""
    ledger = F.col(f"{prefix}ledger_balance")
    none = (ledger >= 0) | (F.col(f"{prefix}account_code") == EXCLUDED_ACCOUNT)
    net = F.abs(ledger) - F.col(f"{prefix}unamortized_fee")
    value = F.when(none, F.lit(0)).otherwise(net)
    return F.when(value < 0, F.lit(0)).otherwise(value)


def gross_carrying_amount(accounts: DataFrame, t22: DataFrame, days: CloseDays) -> DataFrame:
    """``id_product, gca`` with one row for each balance row of an account.

    The caller decides what to do with several; the close reduces the balances
    to one per product first.
    """
    columns = ("ledger_balance", "account_code", "unamortized_fee")
    held = on_day(t22, days.asof_day).select(
        F.col("id_product").alias("asof_key"), *[F.col(c).alias(f"asof_{c}") for c in columns]
    )
    joined = accounts.join(held, F.col("id_product") == F.col("asof_key"), "left")
    return joined.select("id_product", carrying_amount().alias("gca"))


def value_accounts(df: DataFrame) -> DataFrame:
    """``gca`` of accounts that carry the as-of balance; its inputs are dropped."""
    valued = df.withColumn("gca", carrying_amount().cast("double"))
    return valued.drop("asof_ledger_balance", "asof_account_code", "asof_unamortized_fee")


def interest_steps(df: DataFrame) -> DataFrame:
    day = F.col("working_day").cast("date")
    return df.withColumns(
        {
            f"gross_interest_mtd_{ccy}": month_to_date_strict(
                day, F.col(f"gross_interest_daily_{ccy}"), F.col(f"gross_interest_mtd_{ccy}")
            )
            for ccy in ("lcy", "ocy")
        }
    )


def interest_month_to_date(accounts: DataFrame) -> DataFrame:
    """``id_product`` and both month-to-date interests."""
    columns = ("id_product", "gross_interest_mtd_lcy", "gross_interest_mtd_ocy")
    return interest_steps(accounts).select(*columns)
