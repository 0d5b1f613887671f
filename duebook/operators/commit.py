"""Snapshots of the day for the history tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.plans.update import conform, with_surrogate_key
from duebook.schema import SCHEDULE, SNAPSHOT, SNAPSHOT_ZERO_DEFAULTS, error_snapshot


def snapshot(accounts: DataFrame, history: DataFrame | int | None = None) -> DataFrame:
    """Accounts as history rows; rates and counters without a value are 0."""
    defaults = {
        c: F.coalesce(F.col(c), F.lit(0)) for c in SNAPSHOT_ZERO_DEFAULTS if c in accounts.columns
    }
    return with_surrogate_key(conform(accounts.withColumns(defaults), SNAPSHOT), history)


def rejected_snapshot(rejected: DataFrame, history: DataFrame | int | None = None) -> DataFrame:
    """Rejected accounts as history rows: fewer columns, no defaults."""
    narrow = conform(rejected, error_snapshot())
    return with_surrogate_key(conform(narrow, SNAPSHOT), history)


def schedule_snapshot(schedule: DataFrame, history: DataFrame | int | None = None) -> DataFrame:
    return with_surrogate_key(conform(schedule, SCHEDULE), history)


def day_history(accounts: DataFrame, rejected: DataFrame, history: DataFrame | int | None = None) -> DataFrame:
    """All rows of the day for the history table: snapshot and rejected rows.

    They share a slice of the table, so they are written together, with ids that
    are unique over both.
    """
    rows = snapshot(accounts).unionByName(rejected_snapshot(rejected))
    return with_surrogate_key(rows.drop("autoid"), history).select(*SNAPSHOT.names)
