"""Reading the bank's tables by name."""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class SplitRead:
    """How a database read is divided among tasks: equal ranges of a column's values."""

    column: str
    lower: str
    upper: str
    parts: int


@dataclass(frozen=True)
class SplitRows:
    """How a database read is divided among tasks: one condition each, see :func:`split_rows`."""

    predicates: tuple[str, ...]


def split_rows(keys: DataFrame, column: str, parts: int, quote: str = '"') -> SplitRows:
    """Conditions on ``column`` that share out the rows evenly, however its values lie.

    ``keys`` holds the column, or a sample of it: yesterday's copy of the table, say.  Its
    quantiles are the bounds of half-open ranges, NULL goes with the first, and the outer
    ranges are open, so every row of the table meets exactly one condition, also rows
    that ``keys`` lacks.  Text is cut at values of a sample that is as large as the
    quantiles need, since it has no arithmetic; equal bounds are one.
    """
    kind = keys.schema[column].dataType
    known = keys.select(F.col(column).alias("value")).where(F.col(column).isNotNull())
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        bounds = []
    elif isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        found = known.agg(F.percentile_approx("value", F.array(*map(F.lit, shares)), 10_000).alias("bounds")).first()
        bounds = found.bounds or []
    else:
        # ranges of the engine's own sampled partitioning, whose least values bound them
        ranged = known.repartitionByRange(parts, "value").groupBy(F.spark_partition_id().alias("part"))
        least = ranged.agg(F.min("value").alias("value")).collect()  # a row for each part
        bounds = [row.value for row in least]
        bounds = sorted(bounds)[1:]
    name = f"{quote}{column}{quote}"
    marks = [_literal(v) for v in sorted(set(bounds))]
    if not marks:
        return SplitRows((f"{name} is null or {name} is not null",))
    inner = [f"{name} >= {a} and {name} < {b}" for a, b in zip(marks, marks[1:], strict=False)]
    return SplitRows((f"{name} < {marks[0]} or {name} is null", *inner, f"{name} >= {marks[-1]}"))


def _literal(value) -> str:
    if isinstance(value, datetime.datetime):
        return f"timestamp '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, datetime.date):
        return f"date '{value:%Y-%m-%d}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


class Tables(Mapping):
    """Tables by lower-case name, read when first asked for."""

    def __init__(self, reader, names=()):
        self._reader = reader
        self._names = [n.lower() for n in names]
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        name = name.lower()
        if name not in self._frames:
            self._frames[name] = self._reader(name)
        return self._frames[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def parquet_tables(
    spark: SparkSession, root: str, names=(), schemas: Mapping[str, StructType] | None = None
) -> Tables:
    """Tables stored as ``root/<name>``; history tables partitioned by working day.

    With ``schemas`` (such as :data:`duebook.schema.TABLES`) files are not opened to
    infer columns; columns beyond a table's schema are then not read.
    """

    def read(name: str) -> DataFrame:
        reader = spark.read
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        return reader.parquet(f"{root.rstrip('/')}/{name}")

    return Tables(read, names)


def catalog_tables(spark: SparkSession, database: str, names=()) -> Tables:
    return Tables(lambda name: spark.table(f"{database}.{name}"), names)


def jdbc_tables(
    spark: SparkSession,
    options: Mapping[str, str],
    schema: str,
    splits: Mapping[str, SplitRead | SplitRows] | None = None,
    names=(),
) -> Tables:
    """Tables of a database schema.

    ``options`` holds url, user, password and driver.  Day and column filters
    are pushed to the database; a table named in ``splits`` is read by several
    tasks.  Not run here, for want of a database; the conditions are tested apart.
    """

    def read(name: str) -> DataFrame:
        split = (splits or {}).get(name)
        if isinstance(split, SplitRows):
            given = {k: v for k, v in options.items() if k != "url"}
            return spark.read.jdbc(options["url"], f'"{schema}"."{name}"', predicates=list(split.predicates), properties=given)
        reader = spark.read.format("jdbc").options(**options)
        reader = reader.option("dbtable", f'"{schema}"."{name}"')
        if split is not None:
            reader = (
                reader.option("partitionColumn", split.column)
                .option("lowerBound", split.lower)
                .option("upperBound", split.upper)
                .option("numPartitions", split.parts)
            )
        return reader.load()

    return Tables(read, names)
