"""Writing files that nothing else is kept in; see :mod:`duebook.sources.store` for tables
that change."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

DAY_PARTITION = ("working_day",)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = DAY_PARTITION) -> None:
    """Add rows; no rows is fine."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_version(df: DataFrame, path: str, version: str) -> str:
    """A whole table as a new version next to the old ones; returns its path."""
    target = f"{path.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(target)
    return target


def append_jdbc(df: DataFrame, options: Mapping[str, str], schema: str, table: str) -> None:
    writer = df.write.format("jdbc").options(**options)
    writer.option("dbtable", f'"{schema}"."{table}"').mode("append").save()
