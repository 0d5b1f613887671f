"""Default events of the day, for the event log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import CARD_GROUP, LIMITS, RETAIL, Limits
from duebook.functions.calendar import CloseDays
from duebook.functions.flags import day_number, is_one, turned_on
from duebook.functions.reasons import ends_with, mentions
from duebook.operators.delinquency import is_segment
from duebook.plans.lookups import attach_small, one_row_per_key

ANYWHERE, AT_THE_END = "anywhere", "at the end"


@dataclass(frozen=True)
class ReasonEvent:
    """An event seen in the reason text."""

    name: str
    where: str = ANYWHERE

    def seen_in(self, reasons: Column) -> Column:
        return (mentions if self.where == ANYWHERE else ends_with)(reasons, self.name)

    def condition(self) -> Column:
        now = self.seen_in(F.col("default_reason"))
        before = self.seen_in(F.col("p_default_reason"))
        return now & (turned_on("default_indicator") | ~before)


# Event names and how a reason shows them.
DPD_EVENT = "DPD"
REASON_EVENTS = (
    ReasonEvent("CONTRACT TERMINATION"),
    ReasonEvent("DEBT SALE"),
    ReasonEvent("FORECLOSURE COLLATERAL"),
    ReasonEvent("CROSS CONTAGION INDICATOR", AT_THE_END),
    ReasonEvent("CROSS DEFAULT PULLING EFFECT", AT_THE_END),
    ReasonEvent("CREDIT RISK ADJUSTMENT"),
    ReasonEvent("NON ACCRUED STATUS"),
    ReasonEvent("BREACH OF COVENANTS"),
)

EVENT_COLUMNS = (
    "customer_number",
    "account_id",
    "default_trigger_id",
    "default_trigger_description",
    "default_object",
    "event_start_date",
    "event_status",
    "probation_end_reset_date",
    "probation_end_date",
    "corresponding_default_event_id",
    "default_event_id",
    "autoid",
)


def dpd_condition(limits: Limits = LIMITS) -> Column:
    """The counter passes the limit on a retail account in default."""
    return (
        is_one("default_indicator")
        & (F.col("p_dpd_ho") <= limits.event_dpd)
        & (F.col("dpd_ho") > limits.event_dpd)
        & is_segment(RETAIL)
    )


def detected_events(accounts: DataFrame) -> DataFrame:
    """One row per account and event; the accounts are read once for all detectors."""
    detectors = [(DPD_EVENT, dpd_condition())] + [(e.name, e.condition()) for e in REASON_EVENTS]
    found = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in detectors]))
    return accounts.withColumn("event", F.explode(found))


def default_events(accounts: DataFrame, reasons: DataFrame, days: CloseDays) -> DataFrame:
    """Rows for the event log; an event without a reason code uses its name."""
    codes = one_row_per_key(reasons, "reason_desc", ["reason_code"], "code_")
    df = attach_small(detected_events(accounts), codes, "event", "code_key")
    code = F.when(F.col("code_found"), F.col("code_reason_code")).otherwise(F.col("event"))
    nothing = F.lit(None).cast("string")
    until = F.add_months(days.next_day, LIMITS.probation_months)
    return df.select(
        "customer_number",
        F.col("id_product").alias("account_id"),
        code.alias("default_trigger_id"),
        F.col("event").alias("default_trigger_description"),
        nothing.alias("default_object"),
        F.col("working_day").alias("event_start_date"),
        F.lit("ACTIVE").alias("event_status"),
        F.lit(None).cast("date").alias("probation_end_reset_date"),
        F.coalesce("end_probation_date", until).alias("probation_end_date"),
        nothing.alias("corresponding_default_event_id"),
        F.concat(
            day_number(F.col("working_day")).cast("string"), F.col("customer_number"), code
        ).alias("default_event_id"),
        nothing.alias("autoid"),
    )


def events_of_day(log: DataFrame, days: CloseDays) -> DataFrame:
    """The day's slice of the log."""
    return log.filter(F.col("event_start_date") == days.card_day)


def todays_card_events(days: CloseDays) -> Column:
    """Log rows that a rerun of the same day replaces."""
    account = F.col("account_id")
    return (
        (F.col("event_start_date") == days.card_day)
        & (F.substring(account, 1, 2) == CARD_GROUP)
        & (F.length(account) == 26)
        & F.substring(account, 12, 2).isin("18", "19")
    )
