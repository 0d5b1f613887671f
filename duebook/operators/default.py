"""Detection of default: technical resets, days past due, trigger events, customer status."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import (
    LIMITS,
    NONRETAIL,
    OBSERVED,
    RETAIL,
    RETAIL_MIXED_CASE,
    Limits,
    check_mode,
)
from duebook.functions.calendar import DAY, CloseDays
from duebook.functions.flags import is_one, is_zero
from duebook.functions.reasons import distinct_reasons
from duebook.operators import inputs
from duebook.operators.delinquency import is_segment
from duebook.operators.inputs import retail_setting
from duebook.plans.lookups import HotKeys, attach, spread_rows
from duebook.plans.update import update_where

CUSTOMER, PRODUCT = "customer", "product"
BANK_DAY, ROW_DAY, THREE_MONTHS = "bank day", "row day", "three months"


@dataclass(frozen=True)
class Trigger:
    """One kind of event that puts a retail account into default."""

    reason: str
    flag: str
    level: str  # the event names a customer or a product
    when: str  # which events count: of the bank day, of the row's day, of the last three months
    single_only: bool = False  # joint accounts are left out
    distressed_only: bool = False  # the customer must also be past due

    @property
    def column(self) -> str:
        return f"trig_{self.flag}"


# Reason, event flag and rule, in the order reasons are appended.
# The last block repeats the one before it.
TRIGGERS = (
    Trigger("DECEASED", "is_decease_cust", CUSTOMER, BANK_DAY, single_only=True),
    Trigger("BANKCRUPTCY", "is_bankcruptcy", CUSTOMER, BANK_DAY, single_only=True),
    Trigger("CONTRACT TERMINATION", "is_terminated_contract", PRODUCT, BANK_DAY),
    Trigger("LOSS OF SUFFICIENT INCOME", "loss_of_sufficient_income", CUSTOMER, THREE_MONTHS, True, True),
    Trigger("INDEBTEDNESS", "is_indebtedness", CUSTOMER, THREE_MONTHS, True, True),
    Trigger("NON ACCRUED STATUS", "non_accrued_status", PRODUCT, BANK_DAY, single_only=True),
    Trigger("BREACH OF COVENANTS", "breach_contract_covenants", PRODUCT, ROW_DAY),
    Trigger("DEBT SALE", "is_dept_sale_npv", PRODUCT, BANK_DAY),
    Trigger("FORECLOSURE COLLATERAL", "is_foreclosure_collateral", PRODUCT, BANK_DAY),
    Trigger("FORECLOSURE COLLATERAL", "is_foreclosure_collateral", PRODUCT, BANK_DAY),
)

STATUS = (
    "default_indicator",
    "default_reason",
    "proposed_default_ind",
    "is_probation",
    "start_probation_date",
    "end_probation_date",
)
PREVIOUS_STATUS = (
    "p_is_probation",
    "p_proposed_default_ind",
    "p_start_probation_date",
    "p_end_probation_date",
)


# --- technical defaults ---------------------------------------------------------


def technical_products(technical: DataFrame, days: CloseDays) -> DataFrame:
    today = technical.filter(F.col("system_date") == days.bank_day)
    return _distinct_flag(today, "id_product", "tech_product")


def technical_customers(technical: DataFrame, days: CloseDays) -> DataFrame:
    today = technical.filter(F.col("system_date") == days.bank_day)
    return _distinct_flag(today, "customer_number", "tech_customer")


def _distinct_flag(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(F.col(key).alias(f"{name}_key")).distinct().withColumn(name, F.lit(True))


def reset_technical(df: DataFrame) -> DataFrame:
    """Technical defaults lose yesterday's probation."""
    hit = F.coalesce("tech_product", F.lit(False)) | F.coalesce("tech_customer", F.lit(False))
    return update_where(
        df,
        hit,
        {
            "p_is_probation": "0",
            "p_proposed_default_ind": "0",
            "p_start_probation_date": F.lit(None),
            "p_end_probation_date": F.lit(None),
        },
    )


def technical_reset(
    accounts: DataFrame, technical: DataFrame, days: CloseDays, hot: HotKeys | None = None
) -> DataFrame:
    df = attach(accounts, technical_products(technical, days), "id_product", "tech_product_key")
    df = attach(
        df,
        technical_customers(technical, days),
        "customer_number",
        "tech_customer_key",
        "id_product",
        hot,
    )
    return reset_technical(df).select(*accounts.columns)


# --- start of the day -----------------------------------------------------------


def initial_status(df: DataFrame) -> DataFrame:
    """No default yet; probation as yesterday."""
    return df.withColumns(
        {
            "default_indicator": F.lit("0"),
            "default_reason": F.lit(""),
            "proposed_default_ind": F.lit("0"),
            "is_probation": F.col("p_is_probation"),
            "start_probation_date": F.col("p_start_probation_date"),
            "end_probation_date": F.col("p_end_probation_date"),
        }
    )


def new_default(reason: Column, start: Column, limits: Limits = LIMITS) -> dict[str, Column]:
    """Status of an account that defaults today."""
    return {
        "default_indicator": F.lit("1"),
        "default_reason": reason,
        "proposed_default_ind": F.lit("1"),
        "is_probation": F.lit("0"),
        "start_probation_date": start,
        "end_probation_date": F.add_months(start, limits.probation_months),
    }


def days_past_due_default(
    df: DataFrame, tc08: DataFrame, days: CloseDays, mode: str = OBSERVED
) -> DataFrame:
    """Default by days past due.

    Observed: only the mixed-case segment spelling qualifies, and a NULL
    previous reason makes the reason NULL.
    """
    segment = RETAIL_MIXED_CASE if check_mode(mode) else RETAIL
    hit = (F.col("dpd_ho") > retail_setting(tc08, "dpd_threshold")) & is_segment(segment)
    reason = F.concat(F.lit(",DPD,"), F.col("p_default_reason"))
    return update_where(df, hit, new_default(reason, days.next_month))


# --- trigger events ---------------------------------------------------------------


def earliest_day(accounts: DataFrame) -> Column:
    """The first day of the account rows, as a scalar subquery."""
    return accounts.agg(F.min(DAY)).scalar()


def customer_events(
    events: DataFrame, days: CloseDays, since: Column, triggers: Sequence[Trigger] = TRIGGERS
) -> DataFrame:
    """One row per customer: which customer-level events count today, or until when.

    Of the events only the bank day and those that can count on ``since``, the
    first day of the accounts, or later are read; three months back, and three days
    more because months end on different days.
    """
    read = F.col(DAY) == days.bank_day
    if any(t.level == CUSTOMER and t.when == THREE_MONTHS for t in triggers):
        read = read | (F.col(DAY) >= F.date_sub(F.add_months(since, -3), 3))
    events = events.filter(read)
    aggregates = {}
    for trigger in triggers:
        if trigger.level != CUSTOMER:
            continue
        happened = is_one(trigger.flag)
        if trigger.when == BANK_DAY:
            value = F.bool_or(happened & (F.col(DAY) == days.bank_day))
        else:
            value = F.max(F.when(happened, F.add_months(F.col(DAY), 3)))
        aggregates[trigger.column] = value.alias(trigger.column)
    return events.groupBy(F.col("nrp_customer").alias("trig_customer")).agg(*aggregates.values())


def product_events(
    events: DataFrame, days: CloseDays, triggers: Sequence[Trigger] = TRIGGERS
) -> DataFrame:
    """One row per product: which product-level events of the bank day happened."""
    aggregates = {
        t.column: F.bool_or(is_one(t.flag)).alias(t.column)
        for t in triggers
        if t.level == PRODUCT and t.when == BANK_DAY
    }
    today = events.filter(F.col(DAY) == days.bank_day)
    return today.groupBy(F.col("id_product").alias("trig_product")).agg(*aggregates.values())


def on_row_days(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """Events from the first to the last day of the accounts."""
    first, last = earliest_day(accounts), accounts.agg(F.max(DAY)).scalar()
    return events.filter(F.col(DAY).between(first, last))


def attach_row_day_events(df: DataFrame, events: DataFrame, trigger: Trigger) -> DataFrame:
    """Events of the same product and the same day as the account row."""
    happened = (
        on_row_days(events, df)
        .filter(is_one(trigger.flag))
        .select(F.col("id_product").alias("_row_product"), F.col(DAY).alias("_row_day"))
        .distinct()
        .withColumn(trigger.column, F.lit(True))
    )
    same = (F.col("id_product") == F.col("_row_product")) & (F.col(DAY) == F.col("_row_day"))
    return df.join(happened, same, "left").drop("_row_product", "_row_day")


def row_day_products(accounts: DataFrame, events: DataFrame, trigger: Trigger) -> DataFrame:
    """The same as a lookup by product, which needs no extra shuffle of the accounts."""
    keys = accounts.select("id_product", F.col(DAY))
    events = on_row_days(events, accounts)
    happened = events.filter(is_one(trigger.flag)).select("id_product", DAY).distinct()
    products = happened.join(keys, ["id_product", DAY], "left_semi")
    return (
        products.select(F.col("id_product").alias("trig_row_product"))
        .distinct()
        .withColumn(trigger.column, F.lit(True))
    )


def trigger_hit(trigger: Trigger) -> Column:
    if trigger.when == THREE_MONTHS:
        hit = F.col(DAY) <= F.col(trigger.column)
    else:
        hit = F.col(trigger.column)
    hit = hit & is_segment(RETAIL)
    if trigger.single_only:
        hit = hit & is_zero("is_joint")
    if trigger.distressed_only:
        hit = hit & F.col("cust_distressed")
    return F.coalesce(hit, F.lit(False))


def trigger_defaults_steps(
    df: DataFrame, days: CloseDays, triggers: Sequence[Trigger] = TRIGGERS
) -> DataFrame:
    """All triggers at once: one status change, reasons appended in order."""
    hits = {f"_hit{i}": trigger_hit(t) for i, t in enumerate(triggers)}
    reasons = [F.when(F.col(n), f",{t.reason}").otherwise("") for n, t in zip(hits, triggers)]
    reason = F.concat(F.col("default_reason"), *reasons)
    any_hit = reduce(or_, [F.col(name) for name in hits])
    changed = update_where(df.withColumns(hits), any_hit, new_default(reason, days.next_month))
    return changed.drop(*hits)


def trigger_defaults(
    accounts: DataFrame,
    events: DataFrame,
    customers: DataFrame,
    days: CloseDays,
    triggers: Sequence[Trigger] = TRIGGERS,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Defaults by trigger events, for all triggers or some of them."""
    df = spread_rows(accounts, hot, "id_product")
    if any(t.level == PRODUCT and t.when == BANK_DAY for t in triggers):
        df = attach(df, product_events(events, days, triggers), "id_product", "trig_product")
    for trigger in {t.column: t for t in triggers if t.when == ROW_DAY}.values():
        df = attach_row_day_events(df, events, trigger)
    if any(t.level == CUSTOMER for t in triggers):
        lookup = customer_events(events, days, earliest_day(accounts), triggers)
        df = attach(df, lookup, "customer_number", "trig_customer", "id_product", hot)
    if any(t.distressed_only for t in triggers):
        df = inputs.attach_customers(df, customers, columns=[], hot=hot)
    return trigger_defaults_steps(df, days, triggers).select(*accounts.columns)


# --- customer status ----------------------------------------------------------------


def customer_status(df: DataFrame, mode: str = OBSERVED) -> DataFrame:
    """Nonretail accounts take the customer's default indicator.

    Observed: the reason of every other account is blanked as well.
    """
    observed = check_mode(mode)
    matched = F.coalesce(F.col("t01_found") & is_segment(NONRETAIL), F.lit(False))
    reason = F.when(matched & is_one("t01_default_indicator"), ",DPD")
    if not observed:
        reason = reason.when(~matched, F.col("default_reason"))
    indicator = F.when(matched, F.col("t01_default_indicator"))
    return df.withColumns(
        {
            "default_indicator": indicator.otherwise(F.col("default_indicator")),
            "default_reason": reason.otherwise(""),
        }
    )


def without_repeated_reasons(df: DataFrame) -> DataFrame:
    """Repeated reasons of defaulted accounts removed."""
    cleaned = F.when(is_one("default_indicator"), distinct_reasons(F.col("default_reason")))
    return df.withColumn("default_reason", cleaned.otherwise(F.col("default_reason")))


def customer_default(
    accounts: DataFrame, t01: DataFrame, mode: str = OBSERVED, hot: HotKeys | None = None
) -> DataFrame:
    df = inputs.attach_master(accounts, t01, ["default_indicator"], hot)
    return without_repeated_reasons(customer_status(df, mode)).select(*accounts.columns)


def detection_steps(
    df: DataFrame, tc08: DataFrame, days: CloseDays, mode: str = OBSERVED
) -> DataFrame:
    """The whole detection on accounts that carry all lookups."""
    df = initial_status(reset_technical(df))
    df = days_past_due_default(df, tc08, days, mode)
    df = trigger_defaults_steps(df, days)
    return without_repeated_reasons(customer_status(df, mode))


def default_detection(
    accounts: DataFrame,
    technical: DataFrame,
    events: DataFrame,
    customers: DataFrame,
    t01: DataFrame,
    tc08: DataFrame,
    days: CloseDays,
    mode: str = OBSERVED,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Status of the day before probation and contagion.

    All product lookups come first, then all customer lookups.  Customers with very
    many accounts are spread once, so accounts are shuffled once per key.
    """
    df = attach_detection(accounts, accounts, technical, events, days)
    df = spread_rows(df, hot, "id_product")
    df = attach_customer_detection(df, technical, events, days, earliest_day(accounts), hot)
    df = inputs.attach_customers(df, customers, columns=[], hot=hot)
    df = inputs.attach_master(df, t01, ["default_indicator"], hot)
    return detection_steps(df, tc08, days, mode).select(*accounts.columns)


def attach_detection(df, accounts, technical, events, days: CloseDays) -> DataFrame:
    """Product-level lookups of the detection; ``accounts`` gives the keys and days."""
    df = attach(df, product_events(events, days), "id_product", "trig_product")
    for trigger in (t for t in TRIGGERS if t.when == ROW_DAY):
        df = attach(df, row_day_products(accounts, events, trigger), "id_product", "trig_row_product")
    return attach(df, technical_products(technical, days), "id_product", "tech_product_key")


def attach_customer_detection(df, technical, events, days: CloseDays, since, hot=None) -> DataFrame:
    """Customer-level lookups of the detection; ``since`` is the accounts' first day."""
    lookup = customer_events(events, days, since)
    df = attach(df, lookup, "customer_number", "trig_customer", "id_product", hot)
    lookup = technical_customers(technical, days)
    return attach(df, lookup, "customer_number", "tech_customer_key", "id_product", hot)
