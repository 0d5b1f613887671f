"""Probation: its start, its continuation and its end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import (
    CUSTOMER_REASONS_INTENDED,
    CUSTOMER_REASONS_OBSERVED,
    DEAL_REASONS,
    LIMITS,
    OBSERVED,
    PROBATION_PREFIX,
    RETAIL,
    Limits,
    check_mode,
)
from duebook.functions.calendar import CloseDays
from duebook.functions.flags import is_one, is_zero
from duebook.functions.reasons import mentions_any
from duebook.operators import inputs
from duebook.operators.delinquency import is_segment
from duebook.plans.lookups import HotKeys
from duebook.plans.update import update_where


def customer_case(mode: str = OBSERVED) -> Column:
    names = CUSTOMER_REASONS_OBSERVED if check_mode(mode) else CUSTOMER_REASONS_INTENDED
    return mentions_any(F.col("p_default_reason"), names)


def deal_case() -> Column:
    return is_segment(RETAIL) & mentions_any(F.col("p_default_reason"), DEAL_REASONS)


def customer_overdue() -> Column:
    """Days past due of the customer, NULL unless retail with a product."""
    return F.col("cust_retail.max_dpd")


def start_probation(
    df: DataFrame,
    case: Column,
    overdue: Column,
    days: CloseDays,
    mode: str = OBSERVED,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Yesterday's proposed defaults that are no longer proposed.

    Past due: the default stays and its probation dates restart.  Otherwise
    probation begins on yesterday's dates.  Observed: accounts that are past due
    get only the indicator and the proposal, because the proposal is what the
    remaining assignments test.
    """
    hit = case & is_zero("p_is_probation") & is_zero("proposed_default_ind")
    hit = hit & is_one("p_proposed_default_ind")
    late = F.coalesce(overdue > 0, F.lit(False))
    before = F.col("p_default_reason")
    restart = days.next_day
    flags = {"default_indicator": "1", "proposed_default_ind": late.cast("int").cast("string")}
    probation = {
        "default_reason": F.when(late, before).otherwise(F.concat(F.lit(PROBATION_PREFIX), before)),
        "is_probation": F.when(late, "0").otherwise("1"),
        "start_probation_date": F.when(late, restart).otherwise(F.col("p_start_probation_date")),
        "end_probation_date": F.when(
            late, F.add_months(restart, limits.probation_months)
        ).otherwise(F.col("p_end_probation_date")),
    }
    if not check_mode(mode):
        return update_where(df, hit, {**flags, **probation})
    # one pass: the second group of columns changes only where the proposal stayed 0
    begins = hit & ~late
    df = df.withColumns({"_start": F.coalesce(hit, F.lit(False)), "_begin": F.coalesce(begins, F.lit(False))})
    df = update_where(df, F.col("_begin"), probation)
    return update_where(df, F.col("_start"), flags).drop("_start", "_begin")


def continue_probation(
    df: DataFrame, case: Column, overdue: Column, days: CloseDays, limits: Limits = LIMITS
) -> DataFrame:
    """Accounts inside yesterday's probation period; it restarts when past due too long."""
    inside = F.col("working_day").between(
        F.col("p_start_probation_date"), F.col("p_end_probation_date")
    )
    again = overdue > limits.restart_dpd
    return update_where(
        df,
        case & inside & is_one("is_probation"),
        {
            "default_indicator": "1",
            "proposed_default_ind": "0",
            "default_reason": F.when(is_zero("p_is_probation"), F.col("default_reason")).otherwise(
                F.col("p_default_reason")
            ),
            "is_probation": "1",
            "start_probation_date": F.when(again, days.next_day).otherwise(
                F.col("p_start_probation_date")
            ),
            "end_probation_date": F.when(
                again, F.add_months(days.next_day, limits.probation_months)
            ).otherwise(F.col("p_end_probation_date")),
        },
    )


def start_customer_probation(df, days, mode=OBSERVED) -> DataFrame:
    return start_probation(df, customer_case(mode), customer_overdue(), days, mode)


def start_deal_probation(df, days, mode=OBSERVED) -> DataFrame:
    return start_probation(df, deal_case(), F.col("dpd_ho"), days, mode)


def continue_customer_probation(df, days, mode=OBSERVED) -> DataFrame:
    return continue_probation(df, customer_case(mode), customer_overdue(), days)


def continue_deal_probation(df, days) -> DataFrame:
    return continue_probation(df, deal_case(), F.col("dpd_ho"), days)


def probation_steps(df: DataFrame, days: CloseDays, mode: str = OBSERVED) -> DataFrame:
    df = start_deal_probation(start_customer_probation(df, days, mode), days, mode)
    return continue_deal_probation(continue_customer_probation(df, days, mode), days)


def with_customer_overdue(accounts, customers, hot: HotKeys | None = None) -> DataFrame:
    return inputs.attach_customers(accounts, customers, columns=[], hot=hot)


def probation(accounts, customers, days, mode=OBSERVED, hot=None) -> DataFrame:
    df = with_customer_overdue(accounts, customers, hot)
    return probation_steps(df, days, mode).select(*accounts.columns)


def end_probation(
    df: DataFrame, days: CloseDays, mode: str = OBSERVED, limits: Limits = LIMITS
) -> DataFrame:
    """Probations that end between yesterday and today.

    Customers with little past due, no forbearance and no other default leave;
    the rest stay in default until the next day.  Observed: the period test sees
    the newly assigned end date, so an account that leaves (NULL end) is never
    updated and one that stays is updated only if its day is past the close.
    """
    clear = (
        (F.col("cust_retail.max_dpd") < limits.exit_max_dpd)
        & (F.col("cust_retail.is_forbearance_last3m") == "0")
        & (F.col("cust_retail.no_base_defaults") == "0")
    )
    clear = F.coalesce(clear, F.lit(False))
    observed = check_mode(mode)
    end = F.when(~clear, days.next_day) if observed else F.col("p_end_probation_date")
    due = (end > F.col("p_working_day")) & (end <= F.col("working_day")) & is_one("p_is_probation")
    due = due & (~clear if observed else is_one("is_probation"))
    return update_where(
        df,
        due,
        {
            "default_indicator": F.when(clear, "0").otherwise("1"),
            "default_reason": F.when(clear, "").otherwise(F.col("p_default_reason")),
            "proposed_default_ind": "0",
            "is_probation": F.when(clear, "0").otherwise("1"),
            "start_probation_date": F.when(~clear, F.col("p_start_probation_date")),
            "end_probation_date": F.when(~clear, days.next_day),
        },
    )


def probation_end(accounts, customers, days, mode=OBSERVED, hot=None) -> DataFrame:
    df = with_customer_overdue(accounts, customers, hot)
    return end_probation(df, days, mode).select(*accounts.columns)
