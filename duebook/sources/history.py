"""The tables that a close changes, kept in a :class:`~duebook.sources.store.Store`."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from duebook.config import CARD_GROUP
from duebook.functions.calendar import CloseDays
from duebook.plans.lookups import WIDE_ROWS_PER_TASK
from duebook.schema import SCHEDULE, SNAPSHOT, TABLES, UNWINDING
from duebook.sources.store import Add, Change, Replace, ReplaceAll, Store, Stored
from duebook.sources.tables import Tables

HISTORY, SCHEDULES, UNWOUND = "t17_dpd_credit_cards", "t18_cc_payment_schedule", "t14_unwinding"
EVENTS, REGISTER, TYPES = "t19_default_events", "t02_customer_product", "tc01_product_type"


def stored_tables(buckets: int = 64) -> dict[str, Stored]:
    """How they are stored; ``buckets`` files hold the accounts of a day by product."""
    return {
        HISTORY: Stored(SNAPSHOT, ("working_day",), "id_product", buckets, "autoid"),
        SCHEDULES: Stored(SCHEDULE, ("working_day",), ids="autoid"),
        UNWOUND: Stored(UNWINDING, ("working_day", "product_group"), "id_product", buckets, "autoid"),
        EVENTS: Stored(TABLES[EVENTS], ("event_start_date",)),
        REGISTER: Stored(TABLES[REGISTER], (), "id_product", buckets),
        TYPES: Stored(TABLES[TYPES]),
    }


def buckets_for(accounts: int, least: int = 4) -> int:
    """Files for ``accounts`` rows of a day, so that the task of a file takes a bounded number."""
    return max(least, -(-accounts // WIDE_ROWS_PER_TASK))


def history_store(spark: SparkSession, root: str, buckets: int = 64) -> Store:
    return Store(spark, root, stored_tables(buckets))


def close_tables(store: Store, others: Mapping[str, DataFrame], days: CloseDays) -> Tables:
    """All tables of a close: the stored ones, each with the slices that a close reads,
    and ``others``."""
    card, _, _, previous = days.dates(store.spark)
    read = {
        HISTORY: {"working_day": previous},
        UNWOUND: {"working_day": previous},
        EVENTS: {"event_start_date": card},
        REGISTER: {},
        TYPES: {},
    }
    version = store.version()
    return Tables(lambda name: store.read(name, version, read[name]) if name in read else others[name])


def close_changes(outputs: Mapping[str, DataFrame], day: datetime.date) -> list[Change]:
    """What the outputs of a close replace: the day in the histories and in the event
    log, the day's cards in the unwinding table, and the whole register; new product
    types are added."""
    slices = {
        HISTORY: {"working_day": day},
        SCHEDULES: {"working_day": day},
        UNWOUND: {"working_day": day, "product_group": CARD_GROUP},
        EVENTS: {"event_start_date": day},
    }
    changes: list[Change] = [Replace(name, outputs[name], [owned]) for name, owned in slices.items() if name in outputs]
    if REGISTER in outputs:
        changes.append(ReplaceAll(REGISTER, outputs[REGISTER]))
    if TYPES in outputs:
        changes.append(Add(TYPES, outputs[TYPES], "id_product_type"))
    return changes


def publish(outputs: Mapping[str, DataFrame], store: Store, days: CloseDays) -> int:
    """All tables of a close in one commit; returns its number.

    Slices that got no rows are empty afterwards.  Rows of other days and product groups
    stay; publishing a close twice gives the same tables, but for new ids.
    """
    return store.commit(*close_changes(outputs, days.dates(store.spark)[0]))
