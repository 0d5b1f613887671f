"""Set-at-a-time updates of a table by another one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.plans.lookups import one_row_per_key


def update_where(df: DataFrame, hit: Column, assignments: dict) -> DataFrame:
    """Assign all columns at once where ``hit`` is true.

    Values see the row as it was before.  Existing columns keep their type.
    """
    types = dict(df.dtypes)
    lowered = {name.lower(): name for name in types}
    changed = {}
    for name, value in assignments.items():
        name = lowered.get(name.lower(), name)
        value = value if isinstance(value, Column) else F.lit(value)
        if name in types:
            changed[name] = F.when(F.col("_hit"), value.cast(types[name])).otherwise(F.col(name))
        else:
            changed[name] = F.when(F.col("_hit"), value)
    marked = df.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    return marked.withColumns(changed).drop("_hit")


def merge_columns(
    target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Columns of ``target`` replaced from ``updates`` where the key matches.

    A matched row takes the new values, NULLs included; others keep theirs.  Of
    several update rows with one key the smallest wins.
    """
    source = one_row_per_key(updates, key, columns, "_new_")
    joined = target.join(source, F.col(key) == F.col("_new_key"), "left")
    merged = update_where(
        joined, F.col("_new_found"), {c: F.col(f"_new_{c}") for c in columns}
    )
    return merged.drop("_new_key", "_new_found", *[f"_new_{c}" for c in columns])


def set_everywhere(df: DataFrame, column: str, value: Column) -> DataFrame:
    """One value on all rows."""
    return df.withColumn(column, value)


def replace_slice(df: DataFrame, in_slice: Column, rows: DataFrame) -> DataFrame:
    """``df`` with the rows of a slice replaced, so a rerun gives the same table."""
    kept = df.filter(~F.coalesce(in_slice, F.lit(False)))
    return kept.unionByName(rows, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: dict[str, Column],
    insert: dict[str, Column],
    touch_unmatched: bool = False,
) -> DataFrame:
    """Update matched rows and insert new ones with one full outer join.

    Source columns are referred to as ``s_<name>`` in the value expressions.
    ``touch_unmatched`` applies the update to target rows without a source row
    too, which then receive NULLs.
    """
    renamed = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns])
    joined = target.join(renamed, F.col(key) == F.col(f"s_{key}"), "full_outer")
    is_new = F.col(key).isNull()
    is_hit = F.lit(True) if touch_unmatched else F.col(f"s_{key}").isNotNull()
    columns = []
    for field in target.schema.fields:
        name = field.name
        value = F.when(is_new, insert[name].cast(field.dataType) if name in insert else F.lit(None))
        if name in update:
            value = value.when(is_hit, update[name].cast(field.dataType))
        columns.append(value.otherwise(F.col(name)).alias(name))
    return joined.select(*columns)


def with_surrogate_key(rows: DataFrame, history: DataFrame | int | None, column: str = "autoid"):
    """Unique ids above the largest one in ``history``; not contiguous.

    ``history`` may be that largest id itself, so that no table is read.
    """
    base = F.lit(history if isinstance(history, int) else 0)
    if history is not None and not isinstance(history, int):
        base = F.coalesce(history.agg(F.max(column)).scalar(), F.lit(0))
    return rows.withColumn(column, (base + F.monotonically_increasing_id() + 1).cast("long"))


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with exactly the columns of ``schema``; missing ones are NULL."""
    present = {name.lower(): name for name in rows.columns}
    return rows.select(
        *[
            (F.col(present[f.name.lower()]) if f.name.lower() in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )
