"""Default that spreads: to other products, by pulling effect, and repeated default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import (
    CONTAGION_REASON,
    EXCLUDED_ACCOUNT,
    LIMITS,
    OBSERVED,
    PRIVATE_INDIVIDUAL,
    PROBATION_PREFIX,
    PULLING_REASON,
    RETAIL,
    Limits,
    check_mode,
)
from duebook.functions.calendar import CloseDays
from duebook.functions.flags import from_day_number, is_one, stayed_on, turned_on
from duebook.operators import inputs
from duebook.operators.default import STATUS
from duebook.operators.delinquency import is_segment
from duebook.plans.lookups import HotKeys, attach, spread_rows
from duebook.plans.update import update_where

CONTAGION_STATUS = (*STATUS, "default_contagion_indicator")


def can_be_infected() -> Column:
    return (F.col("default_indicator") == "0") & (F.col("account_code") != EXCLUDED_ACCOUNT)


def infect(
    df: DataFrame,
    exposed: Column,
    reason: str,
    days: CloseDays,
    mode: str = OBSERVED,
    limits: Limits = LIMITS,
) -> DataFrame:
    """Default of exposed accounts that are not in default themselves.

    Observed: only the indicator changes, because it is what the remaining
    assignments test.
    """
    hit = exposed & can_be_infected()
    if check_mode(mode):
        return update_where(df, hit, {"default_indicator": "1"})
    on_time = F.col("dpd_ho") == 0
    return update_where(
        df,
        hit,
        {
            "default_indicator": "1",
            "default_contagion_indicator": "1",
            "default_reason": F.when(on_time, PROBATION_PREFIX + reason).otherwise(reason),
            "proposed_default_ind": F.when(on_time, "0").otherwise("1"),
            "is_probation": F.when(on_time, "1").otherwise("0"),
            "start_probation_date": days.next_day,
            "end_probation_date": F.add_months(days.next_day, limits.probation_months),
        },
    )


def default_sources(df: DataFrame) -> DataFrame:
    """Customer and security class of defaulted accounts of private individuals.

    ``df`` carries the customer master and the bank-day balance.
    """
    pulled = (PROBATION_PREFIX + PULLING_REASON, PULLING_REASON)
    source = (
        F.col("bal_found")
        & (F.col("default_indicator") == "1")
        & ~F.col("default_reason").isin(*pulled)
        & (F.col("t01_customer_segment") == PRIVATE_INDIVIDUAL)
        & (F.col("account_code") != EXCLUDED_ACCOUNT)
    )
    return (
        df.filter(source)
        .select(F.col("bal_customer_number").alias("_customer"), F.col("bal_secured_flag").alias("_secured"))
        .distinct()
    )


def attach_contagion(
    df: DataFrame, sources: DataFrame, hot: HotKeys | None = None, among: Column | None = None
) -> DataFrame:
    """``exposed``: the account's customer has a default source of its security class.

    With ``among`` only the rows that meet it are joined; others, which must not depend on
    ``exposed``, are not shuffled and get false.  ``df`` is then read twice.
    """
    on = ["bal_customer_number", "bal_secured_flag"]
    flagged = sources.withColumn("_source", F.lit(True))
    asked = df if among is None else df.filter(among)
    joined = attach(asked, flagged, on, ["_customer", "_secured"], "id_product", hot)
    joined = joined.withColumn("exposed", F.coalesce("_source", F.lit(False))).drop("_source")
    if among is None:
        return joined
    return joined.unionByName(df.filter(~F.coalesce(among, F.lit(False))).withColumn("exposed", F.lit(False)))


def exposure_matters(mode: str = OBSERVED) -> Column:
    """Rows whose status at the end of :func:`contagion_steps` may depend on ``exposed``.

    Observed: only those that have had a default keep what contagion does to them.
    """
    matters = can_be_infected() & F.col("bal_customer_number").isNotNull()
    return matters & once_defaulted() if check_mode(mode) else matters


def cross_default_steps(df, sources, days, mode=OBSERVED, hot=None, among=None) -> DataFrame:
    df = attach_contagion(df, sources, hot, among)
    return infect(df, F.col("exposed"), CONTAGION_REASON, days, mode).drop("exposed")


def attach_cross_default(accounts, t22, t01, days, hot: HotKeys | None = None) -> DataFrame:
    columns = ["customer_number", "secured_flag"]
    df = inputs.attach_balances(accounts, t22, days.bank_day, columns)
    return inputs.attach_master(df, t01, ["customer_segment"], hot)


def cross_default(accounts, t22, t01, days, mode=OBSERVED, hot=None) -> DataFrame:
    df = attach_cross_default(accounts, t22, t01, days, hot)
    hot_balance = hot.renamed("bal_customer_number") if hot else None
    df = cross_default_steps(df, default_sources(df), days, mode, hot_balance)
    return df.select(*accounts.columns)


def pulling_steps(df: DataFrame, days: CloseDays, mode: str = OBSERVED) -> DataFrame:
    return infect(df, F.coalesce("cust_pulling", F.lit(False)), PULLING_REASON, days, mode)


def pulling_effect(accounts, customers, tc08, days, mode=OBSERVED, hot=None) -> DataFrame:
    """Default of customers whose defaulted balances are a large share of the total."""
    df = inputs.attach_customers(accounts, customers, tc08, columns=[], hot=hot)
    return pulling_steps(df, days, mode).select(*accounts.columns)


def repeated_default_end(limits: Limits = LIMITS) -> Column:
    """End of probation, twelve months long after a second default within a year."""
    ended = from_day_number(F.col("p_default_end_date"))
    started = from_day_number(F.col("p_default_start_date"))
    alive = F.instr(F.col("default_reason"), "DECEASED") == 0
    year = F.add_months(F.col("start_probation_date"), limits.reset_months)
    recent = F.add_months(F.col("working_day"), -limits.reset_months) <= ended
    overlaps = F.add_months(ended, limits.reset_months) >= started
    before = F.col("p_end_probation_date")
    ends_now = (before > F.col("p_working_day")) & (before <= F.col("working_day"))
    return (
        F.when(turned_on("default_indicator") & recent & alive, year)
        .when(ends_now, F.col("end_probation_date"))
        .when(stayed_on("default_indicator") & overlaps & alive, year)
        .otherwise(F.col("end_probation_date"))
    )


def once_defaulted() -> Column:
    return is_segment(RETAIL) & F.col("p_default_end_date").isNotNull()


def had_default() -> Column:
    return once_defaulted() & is_one("default_indicator")


def repeated_default(df: DataFrame) -> DataFrame:
    return df.withColumn("end_probation_date", repeated_default_end())


def contagion_steps(
    df: DataFrame, sources: DataFrame, days: CloseDays, mode: str = OBSERVED, hot=None, among: Column | None = None
) -> DataFrame:
    """Cross default, pulling effect and the reset of a repeated default.

    Observed: only retail defaults with an earlier default keep the outcome.  ``among``:
    see :func:`attach_contagion`, for a ``df`` that is cheap to read twice.
    """
    before = {f"_before_{c}": F.col(c) for c in CONTAGION_STATUS}
    after = cross_default_steps(df.withColumns(before), sources, days, mode, hot, among)
    after = repeated_default(pulling_steps(after, days, mode))
    if check_mode(mode):
        after = after.withColumn("_kept", F.coalesce(had_default(), F.lit(False)))
        after = after.withColumns(
            {
                c: F.when(F.col("_kept"), F.col(c)).otherwise(F.col(f"_before_{c}"))
                for c in CONTAGION_STATUS
            }
        ).drop("_kept")
    return after.drop(*before)


def contagion(accounts, t22, t01, customers, tc08, days, mode=OBSERVED, hot=None) -> DataFrame:
    df = attach_cross_default(spread_rows(accounts, hot, "id_product"), t22, t01, days, hot)
    df = inputs.attach_customers(df, customers, tc08, columns=[], hot=hot)
    hot_balance = hot.renamed("bal_customer_number") if hot else None
    return contagion_steps(df, default_sources(df), days, mode, hot_balance).select(*accounts.columns)
