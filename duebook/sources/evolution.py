"""Stored files of older schemas read as the declared one.

A column may become wider, appear or change its place; it may not become narrower,
since files already hold values that would no longer fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}  # decimal digits


class Narrowed(ValueError):
    """A stored column does not fit into the declared one."""


def fits(stored: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of ``stored`` is a value of ``declared``."""
    kind, to = type(stored), type(declared)
    if stored == declared or kind is T.NullType:
        return True
    if kind in _INTEGERS:
        if to in _INTEGERS:
            return _INTEGERS[kind] <= _INTEGERS[to]
        if to is T.DecimalType:
            return declared.precision - declared.scale >= _INTEGERS[kind]
        return to is T.DoubleType and _INTEGERS[kind] <= 10 or to is T.FloatType and _INTEGERS[kind] <= 5
    if kind is T.DecimalType and to is T.DecimalType:
        whole = declared.precision - declared.scale >= stored.precision - stored.scale
        return whole and declared.scale >= stored.scale
    if isinstance(stored, T.StringType):  # also varchar and char of a database
        return to is T.StringType
    return (kind, to) in {(T.FloatType, T.DoubleType), (T.DateType, T.TimestampType), (T.DateType, T.TimestampNTZType)}


def check(stored: T.StructType, declared: T.StructType, table: str = "table") -> None:
    """Raises :class:`Narrowed` for stored columns that would lose values and for those that
    are not declared, naming all of them at once."""
    found = {f.name.lower(): f for f in stored.fields}
    wrong = [
        f"{f.name}: {found[f.name.lower()].dataType.simpleString()} does not fit {f.dataType.simpleString()}"
        for f in declared.fields
        if f.name.lower() in found and not fits(found[f.name.lower()].dataType, f.dataType)
    ]
    known = {f.name.lower() for f in declared.fields}
    wrong += [f"{f.name}: not declared" for name, f in found.items() if name not in known]
    if wrong:
        raise Narrowed(f"{table}: {'; '.join(wrong)}")


def reconcile(df: DataFrame, declared: T.StructType, table: str = "table") -> DataFrame:
    """``df`` with exactly the declared columns: wider types, NULL where a column is missing.

    Raises :class:`Narrowed` where :func:`check` does.
    """
    check(df.schema, declared, table)
    found = {f.name.lower(): f.name for f in df.schema.fields}
    return df.select(
        *[
            (F.col(found[f.name.lower()]) if f.name.lower() in found else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in declared.fields
        ]
    )
