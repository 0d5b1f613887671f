"""Payments and recoveries of the day and of the month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.config import RECOVERY_MOVEMENTS
from duebook.functions.calendar import CloseDays
from duebook.functions.flags import first_of_month, is_one, is_zero, zero_if_null
from duebook.operators.inputs import on_day
from duebook.plans.lookups import attach


def recovery_movements(t26: DataFrame, days: CloseDays) -> DataFrame:
    """Sum of the bank day's write-off and recovery movements by product."""
    counted = F.upper("writteoff_recovery").isin(*RECOVERY_MOVEMENTS)
    moved = on_day(t26, days.bank_day).filter(counted)
    return moved.groupBy("id_product").agg(F.sum("amount_event").alias("sum_amount_event"))


def attach_movements(accounts: DataFrame, t26: DataFrame, days: CloseDays) -> DataFrame:
    sums = recovery_movements(t26, days).withColumnRenamed("id_product", "_moved")
    return attach(accounts, sums, "id_product", "_moved")


def daily_payment(df: DataFrame) -> DataFrame:
    """Fall of the overdue amount that movements do not explain; may be negative."""
    paid = F.col("p_amount_past_due") - F.col("amount_past_due")
    value = F.when(paid > 0, paid - zero_if_null("sum_amount_event")).otherwise(0)
    return df.withColumn("daily_payment", value).drop("sum_amount_event")


def monthly_recovery_steps(df: DataFrame) -> DataFrame:
    """Payments of the month so far: all, in default, and beyond recovery."""
    today = F.col("daily_payment")
    restart = first_of_month(F.col("p_working_day"))
    flag = F.col("absorbing_status_flag").cast("string")
    grown = lambda name: zero_if_null(f"p_{name}") + today
    defaulted = (
        F.when(restart & is_one("default_indicator"), today)
        .when(restart & is_zero("default_indicator"), 0)
        .when(is_one("default_indicator"), grown("monthly_recover_default"))
        .otherwise(zero_if_null("p_monthly_recover_default"))
    )
    absorbed = (
        F.when(restart & (flag == "1"), today)
        .when(restart | (flag == "0"), 0)
        .when(flag == "1", grown("monthly_recover_absorbing"))
        .otherwise(0)
    )
    return df.withColumns(
        {
            "monthly_recover": F.when(restart, today).otherwise(grown("monthly_recover")),
            "monthly_recover_default": defaulted,
            "monthly_recover_absorbing": absorbed,
        }
    )


def monthly_recovery(accounts: DataFrame, t26: DataFrame, days: CloseDays) -> DataFrame:
    return monthly_recovery_steps(daily_payment(attach_movements(accounts, t26, days)))
