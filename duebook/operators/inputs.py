"""What accounts look up, reduced to one row per key.

Balances, customers, their aggregates and joint loans have hardly any key twice, so they
are shuffled first and reduced once; a key that does repeat still gives one row.

Each function returns a lookup for :func:`duebook.plans.lookups.attach` or
attaches it.  Column prefixes say where a value comes from:

``bal_``     card balance on the bank day      ``asof_``  card balance on the as-of day
``cardfx_``  rate of the card currency         ``balfx_`` rate of the balance currency
``cfg_``     settings of the segment           ``t01_``   customer master
``cust_``    today's customer aggregates       ``joint_`` joint loan
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import LIMITS, PRIVATE_INDIVIDUAL, RETAIL
from duebook.functions.calendar import DAY
from duebook.plans.lookups import HotKeys, attach, attach_small, one_row_per_key

MASTER_COLUMNS = ("retail_nonretail", "customer_segment", "default_indicator", "dpd_ho")
CUSTOMER_COLUMNS = ("maximum_days_past_due", "maxdpd_current_month", "dpd_ho2", "default_start_date")
BALANCE_COLUMNS = ("ledger_balance", "account_currency", "customer_number", "secured_flag", "facility_id")
ASOF_COLUMNS = (
    "ledger_balance",
    "account_code",
    "unamortized_fee",
    "account_currency",
    "facility_id",
    "calculation_basis",
)
SETTING_COLUMNS = ("pd_threshold", "percentage_threshold", "pd_threshold2")


def on_day(df: DataFrame, day: Column) -> DataFrame:
    return df.filter(F.col(DAY) == day)


def balances(t22: DataFrame, day: Column, columns, prefix: str) -> DataFrame:
    return one_row_per_key(on_day(t22, day), "id_product", columns, prefix, repeats=False)


def attach_rates(
    df: DataFrame, t20: DataFrame, day: Column, on: str, rate: str, prefix: str
) -> DataFrame:
    """Rate of the currency in ``on`` on one day."""
    rates = one_row_per_key(on_day(t20, day), "currency", [rate], prefix)
    return attach_small(df, rates, on, f"{prefix}key")


def attach_settings(df: DataFrame, tc08: DataFrame) -> DataFrame:
    settings = one_row_per_key(tc08, "segment_type", SETTING_COLUMNS, "cfg_")
    return attach_small(df, settings, "retail_nonretail_indicator", "cfg_key")


def retail_setting(tc08: DataFrame, column: str) -> Column:
    """One setting of the retail segment, NULL where it has no row."""
    return tc08.filter(F.col("segment_type") == RETAIL).agg(F.min(column)).scalar()


def master(t01: DataFrame, columns=MASTER_COLUMNS) -> DataFrame:
    return one_row_per_key(t01, "nrp_customer", columns, "t01_", repeats=False)


def customer_aggregates(
    customers: DataFrame, tc08: DataFrame | None = None, columns=CUSTOMER_COLUMNS
) -> DataFrame:
    """Today's customer values plus three facts about the customer's rows.

    ``cust_retail`` holds the values of a retail row with a product (NULL where
    there is none), ``cust_distressed`` whether such a row is past due for more
    than 60 days, ``cust_pulling`` whether defaulted balances pull the rest in.
    """
    has_product = F.col("has_product") == "1"
    retail = (F.col("retail_nonretail") == RETAIL) & has_product
    share = F.lit(LIMITS.pulling_share)
    if tc08 is not None:
        share = F.coalesce(retail_setting(tc08, "pulling_percentage") / 100, share)
    owed, total = F.col("on_balance_default_eur"), F.col("total_credit_obligation")
    pulling = (
        (F.col("customer_segment") == PRIVATE_INDIVIDUAL)
        & has_product
        & (owed > 0)
        & (total > owed)
        & (owed > share * total)
    )
    marked = customers.withColumns(
        {
            "_retail": F.when(
                retail, F.struct("max_dpd", "is_forbearance_last3m", "no_base_defaults")
            ),
            "_distressed": F.coalesce(retail & (F.col("max_dpd") > LIMITS.distressed_dpd), F.lit(False)),
            "_pulling": F.coalesce(pulling, F.lit(False)),
        }
    )
    facts = {
        "cust_retail": F.min("_retail"),
        "cust_distressed": F.bool_or("_distressed"),
        "cust_pulling": F.bool_or("_pulling"),
    }
    return one_row_per_key(marked, "nrp_customer", columns, "cust_", facts, repeats=False)


def attach_master(df, t01, columns=MASTER_COLUMNS, hot: HotKeys | None = None) -> DataFrame:
    return attach(df, master(t01, columns), "customer_number", "t01_key", "id_product", hot)


def attach_customers(df, customers, tc08=None, columns=CUSTOMER_COLUMNS, hot=None) -> DataFrame:
    lookup = customer_aggregates(customers, tc08, columns)
    return attach(df, lookup, "customer_number", "cust_key", "id_product", hot)


def attach_balances(df, t22, day, columns=BALANCE_COLUMNS, prefix="bal_") -> DataFrame:
    return attach(df, balances(t22, day, columns, prefix), "id_product", f"{prefix}key")


def attach_joint(df: DataFrame, joint: DataFrame) -> DataFrame:
    """Counter of the joint loan, which most accounts do not have."""
    return attach(df, joint_counters(df, joint), "id_product", "key")


def joint_counters(accounts: DataFrame, joint: DataFrame) -> DataFrame:
    """Counter of the joint loan by product; only joint accounts are shuffled for it."""
    members = accounts.filter(F.col("joint_id").isNotNull()).select("id_product", "joint_id")
    hot = HotKeys.find(members, "joint_id")
    loans = one_row_per_key(joint, "joint_id", ["dpd_ho"], "joint_", repeats=False)
    found = attach(members, loans, "joint_id", "joint_key", "id_product", hot)
    return one_row_per_key(found, "id_product", ["joint_dpd_ho"], "").drop("found")
