"""Joins of accounts with the tables they look things up in.

Every lookup is first reduced to one row per key, so a key that repeats on the
lookup side cannot multiply accounts.  The account side may repeat a key as often
as it likes: the rows of a very frequent key are spread over several tasks by
:func:`attach`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 8 << 20
# Rows of one key that a task takes; more are spread.
ROWS_PER_TASK = 200_000
# Accounts with all their columns and lookups that a task takes.
WIDE_ROWS_PER_TASK = 100_000
# Frequent keys that an expression lists; more of them are joined as a small table.
MOST_LISTED = 1_000
# Frequent keys whose names fit into a broadcast for certain; see :meth:`HotKeys.find`.
MOST_HOT_KEYS = 100_000


def fits_in_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of ``df``, as text, have at most ``max_bytes``.

    Reads no more rows than could fit, each counted with 16 bytes at least.
    """
    most = max_bytes // 16
    size = F.sum(F.greatest(F.octet_length(F.to_json(F.struct("*"))), F.lit(16)))
    rows, taken = df.limit(most + 1).agg(F.count("*"), size).first()
    return rows <= most and (taken or 0) <= max_bytes


def one_row_per_key(
    df: DataFrame,
    key: str | Mapping[str, Column],
    columns: Iterable[str],
    prefix: str,
    extra: Mapping[str, Column] | None = None,
    repeats: bool = True,
) -> DataFrame:
    """``df`` reduced to one row per key: the smallest values win (NULL first).

    Rows are reduced before and after the shuffle.  Where keys hardly repeat
    (``repeats`` false) they are shuffled first and reduced once, which saves a
    sort of all rows; the result is the same.

    Gives ``{prefix}key`` (or the named key columns), ``{prefix}<column>`` for
    each column, the aggregates in ``extra`` and ``{prefix}found``.
    """
    keys = {f"{prefix}key": F.col(key)} if isinstance(key, str) else dict(key)
    columns = list(columns)
    aggregates = [value.alias(name) for name, value in (extra or {}).items()]
    if columns:
        row = F.min(F.struct(*[F.col(c).alias(c) for c in columns])).alias("_row")
        aggregates.append(row)
    if not repeats:
        df = df.repartition(*keys.values())
    grouped = df.groupBy(*[value.alias(name) for name, value in keys.items()])
    reduced = grouped.agg(*aggregates) if aggregates else grouped.agg(F.lit(True).alias("_any"))
    return reduced.select(
        *keys,
        *[F.col(f"_row.{c}").alias(f"{prefix}{c}") for c in columns],
        *(extra or {}),
        F.lit(True).alias(f"{prefix}found"),
    )


@dataclass(frozen=True)
class HotKeys:
    """Values of a column so frequent that their rows need several tasks."""

    column: str
    values: Sequence = field(default_factory=tuple)
    nulls: bool = False
    salts: int = 2

    @classmethod
    def find(
        cls, df: DataFrame, column: str, rows_per_task: int = ROWS_PER_TASK, most: int = MOST_HOT_KEYS
    ) -> HotKeys:
        """All values with more than ``rows_per_task`` rows.

        There are fewer than rows divided by ``rows_per_task`` of them; where that is more
        than ``most``, a task takes four times the rows, until they are not.  The most
        frequent one is spread so that a task gets ``rows_per_task`` of its rows.  Reads
        one column and combines counts before the shuffle.
        """
        counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
        while True:
            hot = counts.filter(F.col("n") > rows_per_task).orderBy(F.desc("n"), "value")
            found = hot.limit(most + 1).collect()
            if len(found) <= most:
                break
            rows_per_task *= 4
        values = tuple(row.value for row in found if row.value is not None)
        salts = max(2, -(-found[0].n // rows_per_task)) if found else 2
        return cls(column, values, len(values) < len(found), salts)

    def __bool__(self) -> bool:
        return bool(self.values) or self.nulls

    def renamed(self, column: str) -> HotKeys:
        """The same values in another column."""
        return replace(self, column=column)

    @property
    def salt_column(self) -> str:
        return f"_salt_{self.column}"


def _marked(df: DataFrame, hot: HotKeys, column: str) -> DataFrame:
    """``df`` with ``_hot``: whether the column holds one of the values, NULL apart."""
    if len(hot.values) <= MOST_LISTED:
        is_hot = F.col(column).isin(*hot.values) if hot.values else F.lit(False)
        return df.withColumn("_hot", F.coalesce(is_hot, F.lit(False)))
    kind = df.schema[column].dataType.simpleString()
    listed = df.sparkSession.createDataFrame([(v, True) for v in hot.values], f"_value {kind}, _listed boolean")
    joined = df.join(F.broadcast(listed), F.col(column) == F.col("_value"), "left")
    return joined.withColumn("_hot", F.col("_listed").isNotNull()).drop("_value", "_listed")


def spread_rows(df: DataFrame, hot: HotKeys | None, spread: str) -> DataFrame:
    """``df`` with the salt that several :func:`attach` calls on one column share.

    Rows with a hot or NULL key get a hash of ``spread``, all others 0.  A task
    that runs again places its rows as before.
    """
    if not hot:
        return df
    bucket = F.pmod(F.xxhash64(F.col(spread)), F.lit(hot.salts)).cast("int")
    is_hot = F.col(hot.column).isNull() | F.col("_hot")
    marked = _marked(df, hot, hot.column)
    return marked.withColumn(hot.salt_column, F.when(is_hot, bucket).otherwise(F.lit(0))).drop("_hot")


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    key: str | Sequence[str],
    spread: str | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left join of a lookup that has one row per ``key``; the key is dropped.

    With ``hot`` the rows of frequent keys are spread over tasks (see
    :func:`spread_rows`), and only the lookup rows of those keys are repeated.
    """
    on = [on] if isinstance(on, str) else list(on)
    key = [key] if isinstance(key, str) else list(key)
    match = reduce(and_, (F.col(a) == F.col(b) for a, b in zip(on, key)))
    if not hot or spread is None or hot.column not in on:
        return df.join(lookup, match, "left").drop(*key)

    salted = df if hot.salt_column in df.columns else spread_rows(df, hot, spread)
    every = F.sequence(F.lit(0), F.lit(hot.salts - 1))
    copies = F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))
    repeated = _marked(lookup, hot, key[on.index(hot.column)]).withColumn("_copy", F.explode(copies)).drop("_hot")
    joined = salted.join(repeated, match & (F.col(hot.salt_column) == F.col("_copy")), "left")
    added = [] if hot.salt_column in df.columns else [hot.salt_column]
    return joined.drop(*key, "_copy", *added)


def attach_small(
    df: DataFrame, lookup: DataFrame, on: str, key: str, spread: str = "id_product"
) -> DataFrame:
    """:func:`attach` for settings and rates, whose keys hold many accounts each.

    The lookup is broadcast if its size, which is measured, is small; otherwise it
    is joined by shuffle with the frequent keys spread.
    """
    if fits_in_broadcast(lookup):
        return df.join(F.broadcast(lookup), F.col(on) == F.col(key), "left").drop(key)
    return attach(df, lookup, on, key, spread, HotKeys.find(df, on))


def join_spread(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[Column, Column]],
    spread: tuple[Column, Column],
    rows_per_task: int = ROWS_PER_TASK,
    right_unique: bool = False,
) -> DataFrame:
    """Inner join on equal expressions, NULL never equal, in tasks of bounded size.

    Rows of both sides (of the left one, if the right one has a key once) are counted by
    key, combined before the shuffle.  A key with more
    than ``rows_per_task`` rows on one side is dealt into parts of that size by a hash of
    the ``spread`` expression of that side, and the other side's rows of the key go to
    each part; where both sides have many, a task gets a part of each.  The keys dealt
    are broadcast; where they would not fit, parts are made larger until they do.
    """
    keys = [f"_key{i}" for i in range(len(on))]
    sides = []
    for side, (df, by) in enumerate(zip((left, right), spread, strict=True)):
        given = {name: pair[side] for name, pair in zip(keys, on, strict=True)}
        known = reduce(and_, (F.col(k).isNotNull() for k in keys))
        sides.append(df.withColumns({**given, f"_by{side}": F.xxhash64(by)}).where(known))
    hot = _parts_by_key(sides, keys, rows_per_task, right_unique)
    if hot is None:
        joined = sides[0].join(sides[1], keys)
        return joined.drop(*keys, "_by0", "_by1")
    dealt = []
    for side, df in enumerate(sides):
        marked = df.join(F.broadcast(hot), keys, "left")
        own = F.pmod(F.col(f"_by{side}"), F.coalesce(f"_parts{side}", F.lit(1))).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.coalesce(f"_parts{1 - side}", F.lit(1)).cast("int") - 1))
        placed = marked.withColumn(f"_part{side}", own).withColumn(f"_part{1 - side}", every)
        dealt.append(placed.drop("_parts0", "_parts1", f"_by{side}"))
    return dealt[0].join(dealt[1], [*keys, "_part0", "_part1"]).drop(*keys, "_part0", "_part1")


def _parts_by_key(
    sides: Sequence[DataFrame], keys: Sequence[str], rows_per_task: int, right_unique: bool = False
) -> DataFrame | None:
    """The number of parts of each side for the keys that need several; None for none."""
    each = [df.select(*keys, F.lit(i).alias("_side")) for i, df in enumerate(sides)]
    every = each[0] if right_unique else each[0].union(each[1])
    counts = every.groupBy(*keys).agg(*(F.count(F.when(F.col("_side") == i, 1)).alias(f"_n{i}") for i in (0, 1)))
    while True:
        hot = counts.where(F.greatest("_n0", "_n1") > rows_per_task)
        parts = [F.ceil(F.col(f"_n{i}") / rows_per_task).alias(f"_parts{i}") for i in (0, 1)]
        found = hot.select(*keys, *(F.greatest(p, F.lit(1)).alias(f"_parts{i}") for i, p in enumerate(parts))).limit(MOST_HOT_KEYS + 1).collect()
        if len(found) <= MOST_HOT_KEYS:
            break
        rows_per_task *= 4
    if not found:
        return None
    kinds = ", ".join(f"{k} {sides[0].schema[k].dataType.simpleString()}" for k in keys)
    return sides[0].sparkSession.createDataFrame(found, f"{kinds}, _parts0 long, _parts1 long")


def missing_from(candidates: DataFrame, known: DataFrame, key: Column, known_key: Column):
    """Rows of ``candidates`` whose key is not among the known keys."""
    return candidates.join(known.select(known_key.alias("_known")), key == F.col("_known"), "left_anti")
