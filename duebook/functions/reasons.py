"""Comma-separated default reasons."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_reasons(reasons: Column) -> Column:
    """Repeated reasons removed, first occurrences kept in order."""
    return F.concat_ws(",", F.array_distinct(F.split(reasons, ",")))


def mentions(reasons: Column, name: str) -> Column:
    return F.instr(reasons, name) > 0


def mentions_any(reasons: Column, names: Iterable[str]) -> Column:
    return reasons.rlike("|".join(names))


def ends_with(reasons: Column, name: str) -> Column:
    return reasons.endswith(name)
