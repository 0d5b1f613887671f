"""Yesterday's committed values, carried into today's accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.calendar import CloseDays
from duebook.operators.inputs import on_day
from duebook.plans.lookups import attach, one_row_per_key
from duebook.plans.update import set_everywhere, update_where

# History columns kept under a "p_" name ...
CARRIED_AS_PREVIOUS = (
    "amount_past_due",
    "dpd_ho",
    "times_past_due",
    "maximum_days_past_due",
    "total_days_past_due",
    "current_days_in_excess",
    "date_absorbing_status",
    "exposure_at_absorbing",
    "historical_default_indicator",
    "default_indicator",
    "default_amount",
    "default_start_date",
    "default_end_date",
    "monthly_recover_default",
    "monthly_recover_absorbing",
    "proposed_default_ind",
    "is_probation",
    "start_probation_date",
    "end_probation_date",
    "default_reason",
    "date_since_pd_ho",
    "date_since_pd_ho2",
)
# ... under their own name ...
CARRIED_AS_IS = (
    "default_id",
    "interest_rate_default",
    "eba_status_start_date",
    "gross_interest_mtd_lcy",
    "gross_interest_mtd_ocy",
)
# ... and under another one.
CARRIED_RENAMED = {"maxdpd_current_month": "maxdpd_month"}

CARRIED = {
    **{name: f"p_{name}" for name in CARRIED_AS_PREVIOUS},
    **{name: name for name in CARRIED_AS_IS},
    **CARRIED_RENAMED,
}


def carry_forward(
    accounts: DataFrame, history: DataFrame, days: CloseDays, placed: bool = False
) -> DataFrame:
    """Accounts with the values of the previous card day.

    Accounts without a history row keep what they had; ``p_working_day`` becomes
    the previous day on all of them.  A history that is ``placed`` by product is
    not shuffled.
    """
    previous = on_day(history, days.previous_day)
    lookup = one_row_per_key(previous, "id_product", CARRIED, "prev_", repeats=placed)
    joined = attach(accounts, lookup, "id_product", "prev_key")
    values = {target: F.col(f"prev_{source}") for source, target in CARRIED.items()}
    carried = update_where(joined, F.col("prev_found"), values)
    carried = carried.drop("prev_found", *[f"prev_{source}" for source in CARRIED])
    return set_everywhere(carried, "p_working_day", days.previous_day)
