"""The daily close: all operators in their order.

Accounts are joined with everything keyed by product, then with everything keyed
by customer, so they are shuffled once per key however many tables there are.
The operators then work row by row.  Two intermediate tables are written: one
before contagion, which looks at all accounts of a customer, and one with the
final accounts, from which all outputs are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.config import LIMITS, OBSERVED, check_mode
from duebook.functions.calendar import CloseDays
from duebook.operators import (
    attributes,
    carry_forward,
    commit,
    contagion,
    default,
    delinquency,
    events,
    inputs,
    probation,
    recovery,
    registers,
    unwinding,
    valuation,
)
from duebook.plans.lineage import SHUFFLES, Intermediate
from duebook.plans.lookups import WIDE_ROWS_PER_TASK, HotKeys, attach, spread_rows
from duebook.plans.update import replace_slice

ACCOUNTS = "atmp_t17_dpd_credit_cards"
HISTORY = "t17_dpd_credit_cards"
REJECTED = "err_atmp_t17_dpd_credit_cards"

# Lookup columns the outputs still need after the last step.
KEPT_LOOKUPS = (
    "bal_facility_id",
    "asof_found",
    "asof_facility_id",
    "asof_calculation_basis",
    "asoffx_found",
    "asoffx_all_rate",
    "ecl_overwritten_ecl",
    *unwinding.PREVIOUS,
)


@dataclass(frozen=True)
class Close:
    """Tables, days and settings of one close."""

    tables: Mapping[str, DataFrame]
    days: CloseDays
    mode: str = OBSERVED
    hot: HotKeys | None = None  # customers with very many accounts
    keep: Intermediate = field(default_factory=Intermediate)
    largest_ids: Mapping[str, int] = field(default_factory=dict)  # by table; others are looked up
    placed: int = 0  # files that history, unwinding and register are placed in by product

    @classmethod
    def of(
        cls, tables: Mapping[str, DataFrame], days=None, mode=OBSERVED, hot=None, largest_ids=None, placed=0, run=None
    ) -> Close:
        """``run`` names the inputs of a close that may be resumed, see :func:`fingerprint`."""
        check_mode(mode)
        if days is None:
            days = CloseDays.from_calendars(tables["w01_working_day"], tables["w02_ccworking_day"])
            days = days.resolved(tables[ACCOUNTS].sparkSession)
        if hot is None:
            hot = HotKeys.find(tables[ACCOUNTS], "customer_number")
        keep = Intermediate(None if run is None else fingerprint(tables, days, mode, hot, placed, run))
        return cls(tables, days, mode, hot, keep, largest_ids or {}, placed)

    def clear(self) -> None:
        """Delete the intermediate tables, once the outputs are written."""
        self.keep.clear()

    def ids_above(self, name: str) -> DataFrame | int:
        """What new ids must exceed: the known largest one, else the whole table."""
        return self.largest_ids.get(name, self.tables[name])


# Tables that the accounts of a close are computed from.
INPUTS = (
    ACCOUNTS,
    HISTORY,
    "t22_card_balance",
    "t20_exchange_rate",
    "t26_writteoff_recovery",
    "t01_customer",
    "atmp_customer",
    "atmp_joint_dpd",
    "atmp_default_triggers",
    "technical_default",
    "tc08_configuration_table",
    "vw_unwinding",
    "t14_unwinding",
)


def fingerprint(tables: Mapping[str, DataFrame], days: CloseDays, mode: str, hot: HotKeys, placed: int, run: str) -> str:
    """What decides the intermediate tables of a close: its name, days and settings, the
    columns of its inputs and the names of their files."""
    spark = tables[ACCOUNTS].sparkSession
    parts = [run, mode, str(placed), repr(LIMITS), repr((hot.column, hot.values, hot.nulls, hot.salts))]
    parts += map(str, days.dates(spark))
    for name in INPUTS:
        parts += [name, tables[name].schema.json(), *sorted(tables[name].inputFiles())]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


# --- lookups ------------------------------------------------------------------


def by_product(accounts: DataFrame, placed: int = 0) -> DataFrame:
    """Accounts shuffled by product; the joins by product then leave them in place, and
    tables placed by product in so many files as well."""
    return accounts.repartition(*([placed] if placed else []), "id_product")


def attach_by_product(df: DataFrame, accounts: DataFrame, close: Close) -> DataFrame:
    """Everything keyed by product.  Values that depend on nothing later are
    computed at once, so that fewer columns travel on.

    ``accounts`` are the accounts as stored, for lookups that need a few of
    their columns.
    """
    tables, days = close.tables, close.days
    df = inputs.attach_balances(df, tables["t22_card_balance"], days.bank_day)
    df = inputs.attach_balances(
        df, tables["t22_card_balance"], days.asof_day, inputs.ASOF_COLUMNS, "asof_"
    )
    df = valuation.value_accounts(df)
    joint = inputs.joint_counters(accounts, tables["atmp_joint_dpd"])
    df = attach(df, joint, "id_product", "key")
    df = default.attach_detection(
        df, accounts, tables["technical_default"], tables["atmp_default_triggers"], days
    )
    df = recovery.attach_movements(df, tables["t26_writteoff_recovery"], days)
    df = recovery.daily_payment(df)
    return unwinding.attach_allowance(df, tables["vw_unwinding"])


def attach_by_customer(df: DataFrame, accounts: DataFrame, close: Close, loose: bool = False) -> DataFrame:
    """Everything keyed by customer, for ``df`` that lies by product.

    The wide rows stay where they are: the products and customers of ``accounts`` go to the
    customers and come back with what was found.  Accounts without a product cannot be
    found again by it, so ``loose``, if there are any, sends those to the customers whole.
    """
    pairs = accounts.select("id_product", "customer_number").dropna()
    pairs = spread_rows(pairs, close.hot, "id_product")
    pairs = pairs.repartition(*[c for c in pairs.columns if c != "id_product"]).distinct()
    found = _with_customer_lookups(pairs, close).withColumnsRenamed(
        {"id_product": "_pair_product", "customer_number": "_pair_customer"}
    )
    found = found.repartition(*([close.placed] if close.placed else []), "_pair_product")
    named = attach(
        df.filter(F.col("id_product").isNotNull()) if loose else df,
        found,
        ["id_product", "customer_number"],
        ["_pair_product", "_pair_customer"],
    )
    if not loose:
        return named
    return named.unionByName(_with_customer_lookups(df.filter(F.col("id_product").isNull()), close))


def _with_customer_lookups(df: DataFrame, close: Close) -> DataFrame:
    tables, days, hot = close.tables, close.days, close.hot
    df = spread_rows(df, hot, "id_product") if hot and hot.salt_column not in df.columns else df
    df = inputs.attach_master(df, tables["t01_customer"], hot=hot)
    df = inputs.attach_customers(
        df, tables["atmp_customer"], tables["tc08_configuration_table"], hot=hot
    )
    df = default.attach_customer_detection(
        df,
        tables["technical_default"],
        tables["atmp_default_triggers"],
        days,
        default.earliest_day(tables[ACCOUNTS]),
        hot,
    )
    return df.drop(hot.salt_column) if hot else df


def attach_settings_and_rates(df: DataFrame, close: Close) -> DataFrame:
    """After the segment is refreshed, which the settings depend on."""
    df = delinquency.attach_bank_day_rates(df, close.tables["t20_exchange_rate"], close.days)
    df = unwinding.attach_asof_rates(df, close.tables["t20_exchange_rate"], close.days)
    return inputs.attach_settings(df, close.tables["tc08_configuration_table"])


# --- row steps ----------------------------------------------------------------


def delinquency_steps(df: DataFrame, close: Close) -> DataFrame:
    df = delinquency.days_past_due_steps(df, close.days)
    df = delinquency.second_counter_steps(df, close.mode)
    return delinquency.counter_steps(df)


def detection_and_probation(df: DataFrame, close: Close) -> DataFrame:
    df = default.detection_steps(
        df, close.tables["tc08_configuration_table"], close.days, close.mode
    )
    df = probation.probation_steps(df, close.days, close.mode)
    return probation.end_probation(df, close.days, close.mode)


def contagion_and_attributes(df: DataFrame, close: Close) -> DataFrame:
    """``df`` is an intermediate table: it is read for the frequent customers, for
    the sources and again for the rows, of which only those are shuffled that contagion
    can change."""
    among = contagion.exposure_matters(close.mode)
    hot = HotKeys.find(df.filter(among), "bal_customer_number")
    sources = contagion.default_sources(df)
    df = contagion.contagion_steps(df, sources, close.days, close.mode, hot, among)
    return attributes.default_attributes_steps(df, close.mode)


def closing_steps(df: DataFrame, close: Close) -> DataFrame:
    return delinquency.eba_status(recovery.monthly_recovery_steps(df))


# --- compositions -------------------------------------------------------------


def _columns(accounts: DataFrame, df: DataFrame, *more: str) -> list[str]:
    computed = (*delinquency.COUNTERS, *attributes.ATTRIBUTES, "date_since_pd_ho", "daily_payment")
    wanted = [*accounts.columns, *computed, *COMPUTED_LATE, *more]
    return [c for c in dict.fromkeys(wanted) if c in df.columns]


COMPUTED_LATE = (
    "monthly_recover",
    "monthly_recover_default",
    "monthly_recover_absorbing",
    "eba_status",
    "eba_status_start_date",
)


def _dealt(accounts: DataFrame, close: Close) -> tuple[int, bool]:
    """The parts that accounts by product are shuffled into, which grow with their number
    unless they are placed, and whether there are accounts without a product."""
    rows, named = accounts.agg(F.count("*"), F.count("id_product")).first()
    parts = max(int(accounts.sparkSession.conf.get(SHUFFLES)), -(-rows // WIDE_ROWS_PER_TASK))
    return close.placed or parts, named < rows


def default_engine(accounts: DataFrame, close: Close) -> DataFrame:
    """Detection, probation, contagion and attributes of a default."""
    parts, loose = _dealt(accounts, close)
    df = attach_by_product(by_product(accounts, close.placed), accounts, close)
    df = attach_by_customer(df, accounts, close, loose)
    df = close.keep(detection_and_probation(df, close), "before-contagion", parts)
    return contagion_and_attributes(df, close).select(*accounts.columns)


def account_formulas(accounts: DataFrame, close: Close) -> DataFrame:
    """Everything computed per account."""
    df = _formulas(by_product(accounts, close.placed), accounts, close)
    return df.select(*_columns(accounts, df))


def _formulas(df: DataFrame, accounts: DataFrame, close: Close) -> DataFrame:
    parts, loose = _dealt(accounts, close)
    df = valuation.interest_steps(attach_by_product(df, accounts, close))
    df = attach_by_customer(df, accounts, close, loose)
    df = attach_settings_and_rates(delinquency.refresh_segment(df), close)
    df = detection_and_probation(delinquency_steps(df, close), close)
    df = close.keep(df, "before-contagion", parts)
    return closing_steps(contagion_and_attributes(df, close), close)


def unwinding_close(accounts: DataFrame, close: Close) -> DataFrame:
    """Today's unwinding rows with all amounts."""
    tables, days = close.tables, close.days
    rows = unwinding.insert_unwinding(
        accounts,
        tables["t22_card_balance"],
        tables["t20_exchange_rate"],
        tables["vw_unwinding"],
        days,
    )
    return unwinding.unwinding_amounts(
        rows, tables["t14_unwinding"], tables["t20_exchange_rate"], days
    )


def daily_close(close: Close, run_at: Column | None = None) -> dict[str, DataFrame]:
    """All outputs of one day.

    ``accounts``: today's accounts.  ``t17_dpd_credit_cards`` (accepted and
    rejected accounts), ``t18_cc_payment_schedule``, ``t14_unwinding`` (cards) and
    ``t19_default_events`` (new rows and today's rows that stay): the slices that
    :func:`duebook.sources.history.publish` replaces.  ``t02_customer_product``: the
    whole table.  ``tc01_product_type``: new rows.

    Not lazy: frequent keys are counted and two intermediate tables are written
    while the outputs are built.  A close with a ``run`` that failed after one of them
    reads it when it is called again.
    """
    tables, days = close.tables, close.days
    run_at = F.current_timestamp() if run_at is None else run_at
    stored = tables[ACCOUNTS]
    carried = carry_forward.carry_forward(
        by_product(stored, close.placed), tables[HISTORY], days, bool(close.placed)
    )
    # one join with the others by product, instead of one for each reader of the rows
    carried = unwinding.attach_previous(carried, tables["t14_unwinding"], days)
    held = len(close.keep.paths)
    closed = _formulas(carried, stored, close)
    closed = close.keep(closed.select(*_columns(stored, closed, *KEPT_LOOKUPS)), "closed-accounts")
    close.keep.release(held, len(close.keep.paths) - 1)  # all outputs read the closed accounts
    accounts = closed.drop(*KEPT_LOOKUPS)
    event_rows = events.default_events(accounts, tables["tc_default_reason"], days)
    register_rows = registers.product_register_source(closed, close.placed)
    unwinding_rows = unwinding.unwinding_rows(closed, *unwinding.PREVIOUS)
    unwound = unwinding.unwinding_amounts_steps(unwinding_rows, tables["t20_exchange_rate"], days)
    return {
        "accounts": accounts,
        "t19_default_events": replace_slice(
            events.events_of_day(tables["t19_default_events"], days),
            events.todays_card_events(days),
            event_rows,
        ),
        "t14_unwinding": unwinding.as_stored(unwound, close.ids_above("t14_unwinding")),
        "tc01_product_type": registers.new_product_types(accounts, tables["tc01_product_type"]),
        "t02_customer_product": registers.merge_product_register(
            tables["t02_customer_product"], register_rows, run_at, close.mode
        ),
        "t17_dpd_credit_cards": commit.day_history(accounts, tables[REJECTED], close.ids_above(HISTORY)),
        "t18_cc_payment_schedule": commit.schedule_snapshot(
            tables["atmp_t18_cc_payment_schedule"], close.ids_above("t18_cc_payment_schedule")
        ),
    }
