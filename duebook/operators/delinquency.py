"""Days past due, their counters, the absorbing status and the EBA status.

``attach_*`` adds lookups, the other functions work on single rows.  The close
attaches all lookups once and then runs the row functions in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import (
    LIMITS,
    NONRETAIL,
    NONRETAIL_HYPHEN,
    OBSERVED,
    RETAIL,
    Limits,
    check_mode,
)
from duebook.functions.calendar import CloseDays
from duebook.functions.flags import first_of_month, is_one, turned_off, turned_on, zero_if_null
from duebook.operators import inputs
from duebook.plans.lookups import HotKeys

SEGMENT = "retail_nonretail_indicator"


def is_segment(name: str) -> Column:
    return F.col(SEGMENT) == name


# --- segment ----------------------------------------------------------------


def refresh_segment(df: DataFrame) -> DataFrame:
    """The segment of the customer master where it has one."""
    return df.withColumn(SEGMENT, F.coalesce(F.col("t01_retail_nonretail"), F.col(SEGMENT)))


def segment_refresh(accounts: DataFrame, t01: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    joined = inputs.attach_master(accounts, t01, ["retail_nonretail"], hot)
    return refresh_segment(joined).select(*accounts.columns)


# --- materiality and days past due --------------------------------------------


def materiality(df: DataFrame) -> DataFrame:
    """The larger of the segment's amount threshold and its share of the balance."""
    ledger = F.when(F.col("balfx_found"), F.col("bal_ledger_balance"))
    share = F.col("cfg_percentage_threshold") / 100 * ledger
    known = (
        F.col("cfg_pd_threshold").isNotNull()
        & F.col("cfg_percentage_threshold").isNotNull()
        & ledger.isNotNull()
    )
    level = F.when(known, F.greatest(F.col("cfg_pd_threshold"), share))
    return df.withColumn("materiality_level", level.otherwise(F.col("materiality_level")))


def count_days_past_due(df: DataFrame, days: CloseDays) -> DataFrame:
    """Retail accounts: start, continue or reset the counter."""
    overdue = F.col("amount_past_due")
    in_eur = overdue * F.col("cardfx_eur_rate")
    level, before = F.col("materiality_level"), F.col("p_dpd_ho")
    later = before + F.datediff(days.bank_day, F.col("p_working_day"))
    lingering = (in_eur <= level) & (overdue > 0) & (overdue >= F.col("p_amount_past_due"))
    counter = (
        F.when((in_eur > level) & (before == 0), F.lit(1))
        .when(((in_eur > level) | lingering) & (before > 0), later)
        .otherwise(F.lit(0))
    )
    counted = F.when(is_segment(RETAIL), counter).otherwise(F.col("dpd_ho"))
    return df.withColumn("dpd_ho", counted.cast("int"))


def joint_days_past_due(df: DataFrame) -> DataFrame:
    """Joint retail accounts take the counter of the joint loan, even if NULL."""
    joint = is_segment(RETAIL) & is_one("is_joint")
    return df.withColumn(
        "dpd_ho", F.when(joint, F.col("joint_dpd_ho").cast("int")).otherwise(F.col("dpd_ho"))
    )


def customer_days_past_due(df: DataFrame) -> DataFrame:
    """Nonretail accounts take the counter of the customer where there is one."""
    known = is_segment(NONRETAIL) & F.col("t01_dpd_ho").isNotNull()
    return df.withColumn(
        "dpd_ho", F.when(known, F.col("t01_dpd_ho").cast("int")).otherwise(F.col("dpd_ho"))
    )


def past_due_since(df: DataFrame) -> DataFrame:
    begun = F.when(F.col("p_date_since_pd_ho").isNull(), F.col("working_day")).otherwise(
        F.date_sub(F.col("working_day"), F.col("dpd_ho"))
    )
    return df.withColumn("date_since_pd_ho", F.when(F.col("dpd_ho") > 0, begun))


def days_past_due_steps(df: DataFrame, days: CloseDays) -> DataFrame:
    df = count_days_past_due(materiality(df), days)
    return past_due_since(customer_days_past_due(joint_days_past_due(df)))


def days_past_due(
    accounts: DataFrame,
    t22: DataFrame,
    t20: DataFrame,
    joint: DataFrame,
    t01: DataFrame,
    tc08: DataFrame,
    days: CloseDays,
    hot: HotKeys | None = None,
) -> DataFrame:
    """``materiality_level``, ``dpd_ho`` and ``date_since_pd_ho`` of all accounts."""
    df = inputs.attach_balances(accounts, t22, days.bank_day, ["ledger_balance", "account_currency"])
    df = inputs.attach_master(df, t01, ["dpd_ho"], hot)
    df = inputs.attach_joint(df, joint)
    df = attach_bank_day_rates(df, t20, days)
    df = inputs.attach_settings(df, tc08)
    return days_past_due_steps(df, days).select(*_with(accounts, "date_since_pd_ho"))


def attach_bank_day_rates(df: DataFrame, t20: DataFrame, days: CloseDays) -> DataFrame:
    df = inputs.attach_rates(df, t20, days.bank_day, "card_ccy", "eur_rate", "cardfx_")
    return inputs.attach_rates(df, t20, days.bank_day, "bal_account_currency", "eur_rate", "balfx_")


def _with(accounts: DataFrame, *columns: str) -> list[str]:
    return list(accounts.columns) + [c for c in columns if c not in accounts.columns]


# --- second counter -----------------------------------------------------------


def second_counter_steps(df: DataFrame, mode: str = OBSERVED) -> DataFrame:
    """``date_since_pd_ho2`` and ``dpd_ho2``.  The date never clears once set."""
    over = (
        F.try_divide(F.col("amount_past_due"), F.col("balfx_eur_rate")) > F.col("cfg_pd_threshold2")
    )
    since = F.when(over, F.coalesce(F.col("p_date_since_pd_ho2"), F.col("working_day")))
    current = F.col("date_since_pd_ho2")
    df = df.withColumn(
        "date_since_pd_ho2",
        F.when(F.col("amount_past_due") > 0, F.coalesce(since, current)).otherwise(current),
    )
    spellings = [NONRETAIL_HYPHEN] if check_mode(mode) else [NONRETAIL_HYPHEN, NONRETAIL]
    elapsed = F.datediff(F.col("working_day"), F.col("date_since_pd_ho2"))
    counter = (
        F.when(is_segment(RETAIL), F.coalesce(elapsed, F.lit(0)))
        .when(F.col(SEGMENT).isin(*spellings), F.col("cust_dpd_ho2"))
        .otherwise(F.col("dpd_ho2"))
    )
    return df.withColumn("dpd_ho2", counter.cast("int"))


def second_counter(
    accounts: DataFrame,
    t22: DataFrame,
    t20: DataFrame,
    customers: DataFrame,
    tc08: DataFrame,
    days: CloseDays,
    mode: str = OBSERVED,
    hot: HotKeys | None = None,
) -> DataFrame:
    df = inputs.attach_balances(accounts, t22, days.bank_day, ["account_currency"])
    df = inputs.attach_customers(df, customers, columns=["dpd_ho2"], hot=hot)
    df = inputs.attach_rates(df, t20, days.bank_day, "bal_account_currency", "eur_rate", "balfx_")
    df = inputs.attach_settings(df, tc08)
    return second_counter_steps(df, mode).select(*accounts.columns)


# --- counters -----------------------------------------------------------------


def times_past_due(df: DataFrame) -> DataFrame:
    before = zero_if_null("p_times_past_due")
    begins = (F.col("p_dpd_ho") == 0) & (F.col("dpd_ho") > 0)
    return df.withColumn("times_past_due", F.when(begins, before + 1).otherwise(before))


def of_customer(name: str, own: Column) -> Column:
    """The customer's value for nonretail accounts with a customer row."""
    return F.when(is_segment(NONRETAIL) & F.col("cust_found"), F.col(f"cust_{name}")).otherwise(own)


def maximum_days_past_due(df: DataFrame) -> DataFrame:
    before = zero_if_null("p_maximum_days_past_due")
    own = F.when(F.col("dpd_ho") > before, F.col("dpd_ho")).otherwise(before)
    return df.withColumn("maximum_days_past_due", of_customer("maximum_days_past_due", own))


def total_days_past_due(df: DataFrame) -> DataFrame:
    before = zero_if_null("p_total_days_past_due")
    return df.withColumn(
        "total_days_past_due", F.when(F.col("dpd_ho") > 0, before + 1).otherwise(before)
    )


def current_days_in_excess(df: DataFrame) -> DataFrame:
    counted = (
        F.when(F.col("working_day").isNull(), F.lit(0))
        .when(first_of_month(F.col("working_day")), F.lit(1))
        .otherwise(zero_if_null("p_current_days_in_excess") + 1)
    )
    return df.withColumn(
        "current_days_in_excess", F.when(F.col("dpd_ho") > 0, counted).otherwise(F.lit(0))
    )


def month_maximum(df: DataFrame) -> DataFrame:
    """Largest counter of the month; restarts on its first day."""
    so_far = zero_if_null("maxdpd_month")
    running = F.when(so_far > F.col("dpd_ho"), so_far).otherwise(F.col("dpd_ho"))
    retail = F.when(first_of_month(F.col("working_day")), F.col("dpd_ho")).otherwise(running)
    own = F.when(is_segment(RETAIL), retail).otherwise(F.col("maxdpd_current_month"))
    return df.withColumn("maxdpd_current_month", of_customer("maxdpd_current_month", own))


def absorbing_status(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Flag, date and exposure of accounts past due beyond recovery."""
    absorbing = F.coalesce(F.col("maximum_days_past_due") >= limits.absorbing_dpd, F.lit(False))
    exposure = zero_if_null("p_exposure_at_absorbing")
    enters = absorbing & (exposure == 0) & (F.col("card_balance") > 0)
    return df.withColumns(
        {
            "absorbing_status_flag": absorbing.cast("int"),
            "date_absorbing_status": F.coalesce(
                F.col("p_date_absorbing_status"), F.when(absorbing, F.col("working_day"))
            ),
            "exposure_at_absorbing": F.when(enters, F.col("card_balance")).otherwise(exposure),
        }
    )


COUNTERS = (
    "times_past_due",
    "maximum_days_past_due",
    "total_days_past_due",
    "current_days_in_excess",
    "maxdpd_current_month",
    "absorbing_status_flag",
    "date_absorbing_status",
    "exposure_at_absorbing",
)


def counter_steps(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    df = maximum_days_past_due(times_past_due(df))
    df = current_days_in_excess(total_days_past_due(df))
    return absorbing_status(month_maximum(df), limits)


def counters(accounts: DataFrame, customers: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    columns = ["maximum_days_past_due", "maxdpd_current_month"]
    df = inputs.attach_customers(accounts, customers, columns=columns, hot=hot)
    return counter_steps(df).select(*_with(accounts, *COUNTERS))


# --- EBA status ---------------------------------------------------------------


def eba_status(df: DataFrame) -> DataFrame:
    """Performing or not, and the day that last changed."""
    flipped = turned_on("default_indicator") | turned_off("default_indicator")
    since = F.when(flipped, F.col("working_day")).otherwise(
        F.coalesce(F.col("eba_status_start_date"), F.col("working_day"))
    )
    status = F.when(is_one("default_indicator"), "NPE").otherwise("PE")
    return df.withColumns({"eba_status": status, "eba_status_start_date": since})
