"""Stored tables that change by commits.

Every change of a table writes new files in a folder of its own, ``_change=<name>``;
files are never overwritten.  A commit record then says, for all tables at once, which
folders and files make up each of them.  Readers resolve the newest complete record, so
they see all tables of a close or none of them, and a failed close leaves files that no
record names (:meth:`Store.vacuum` deletes them).

A record has a row for each folder of a slice (or file, after a keyed update), as much as
Spark lists to read the table.  One close at a time may write to a store.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.plans.lineage import CODEC, RELEASED, Files, Intermediate, settings
from duebook.plans.lookups import fits_in_broadcast, missing_from
from duebook.plans.update import conform, merge_columns
from duebook.sources.evolution import check, reconcile

CHANGE = "_change"
COMMITS, IDS = "_commits", "_ids"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for NULL
# a scan of placed files has a task for each bucket, also where no join asks for it
BY_BUCKET = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}
RECORD = "table string, slice string, path string, schema string, buckets int"


@dataclass(frozen=True)
class Stored:
    """How a table is stored.

    ``slices``: columns whose values have folders of their own.  ``placed_by`` and
    ``buckets``: rows lie in files by a hash of this column, so that joins by it read
    them where they are.  ``ids``: column that gets reserved numbers.
    """

    schema: T.StructType
    slices: tuple[str, ...] = ()
    placed_by: str | None = None
    buckets: int = 0
    ids: str | None = None


@dataclass(frozen=True)
class Replace:
    """``rows`` replace all rows of the slices in ``owned``, also those without new rows.

    Each owned slice gives values of some of the table's slice columns; rows outside of
    all of them are an error.
    """

    table: str
    rows: DataFrame
    owned: Sequence[Mapping[str, object]]


@dataclass(frozen=True)
class ReplaceAll:
    table: str
    rows: DataFrame


@dataclass(frozen=True)
class Add:
    """``rows`` are added; with ``key``, only those whose key the table does not hold."""

    table: str
    rows: DataFrame
    key: str | None = None


@dataclass(frozen=True)
class Update:
    """Rows whose ``key`` is in ``updates`` get its ``columns``, NULLs included.

    Only files that hold such a key are written anew.
    """

    table: str
    updates: DataFrame
    key: str
    columns: Sequence[str]


Change = Replace | ReplaceAll | Add | Update


@dataclass(frozen=True)
class Entry:
    """A folder or file of a table; ``slice`` is its path below the change's folder.

    ``buckets`` is the number of files its rows are placed in, 0 if they lie anywhere.
    """

    table: str
    slice: str
    path: str
    schema: str
    buckets: int = 0

    def values(self) -> dict[str, str | None]:
        pairs = (unquote(part).partition("=") for part in self.slice.split("/") if part)
        return {column: None if value == NO_VALUE else value for column, _, value in pairs}

    def within(self, owned: Mapping[str, object]) -> bool:
        mine = self.values()
        return all(mine[c] == (None if v is None else str(v)) for c, v in owned.items())


class Store:
    """Tables below ``root``, a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, Stored]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), dict(tables)
        self.files = Files(spark)
        self._views: list[str] = []

    # --- records ----------------------------------------------------------------

    def _versions(self) -> dict[int, bool]:
        """All record numbers, and whether the record is complete."""
        found = {}
        for name in self.files.names(f"{self.root}/{COMMITS}"):
            if name.startswith("version="):
                found[int(name.partition("=")[2])] = self.files.exists(f"{self.root}/{COMMITS}/{name}/_SUCCESS")
        return found

    def version(self) -> int:
        """The newest complete commit; 0 for an empty store."""
        return max((n for n, complete in self._versions().items() if complete), default=0)

    def entries(self, version: int | None = None) -> list[Entry]:
        version = self.version() if version is None else version
        if not version:
            return []
        rows = self.spark.read.schema(RECORD).parquet(f"{self.root}/{COMMITS}/version={version}").collect()
        return [Entry(*row) for row in rows]

    def _record(self, entries: Iterable[Entry]) -> int:
        number = max(self._versions(), default=0) + 1
        rows = [(e.table, e.slice, e.path, e.schema, e.buckets) for e in entries]
        record = self.spark.createDataFrame(rows, RECORD).coalesce(1)
        record.write.mode("errorifexists").parquet(f"{self.root}/{COMMITS}/version={number}")
        return number

    # --- reading ----------------------------------------------------------------

    def read(self, table: str, version: int | None = None, only: Mapping[str, object] | None = None) -> DataFrame:
        """A table as of a commit, with its declared columns.

        ``only`` picks slices by their values before any file is listed.  Files of older
        schemas are widened; a column that became narrower is an error.  A table placed by
        a column has a name in the session's catalog until :meth:`forget`.
        """
        spec = self.tables[table]
        entries = self._entries_of(table, version, only)
        schemas = list(dict.fromkeys(e.schema for e in entries))
        parts = []
        for schema in schemas:
            stored = T.StructType.fromJson(json.loads(schema))
            mine = [e for e in entries if e.schema == schema]
            rows = self._placed(spec, stored, mine) if len(schemas) == 1 else None
            parts.append(reconcile(self._plain(table, stored, mine) if rows is None else rows, spec.schema, table))
        if not parts:
            return self.spark.createDataFrame([], spec.schema)
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.union(part)
        return whole

    def _entries_of(self, table: str, version: int | None = None, only: Mapping[str, object] | None = None) -> list[Entry]:
        return [e for e in self.entries(version) if e.table == table and e.within(only or {})]

    def _plain(self, table: str, schema: T.StructType, entries: Sequence[Entry], *more: Column) -> DataFrame:
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*[f"{self.root}/{e.path}" for e in entries]).select(*schema.names, *more)

    def _placed(self, spec: Stored, schema: T.StructType, entries: Sequence[Entry]) -> DataFrame | None:
        """The entries as a bucketed table of this session: a scan that is partitioned by
        its column already.  None where a slice has several folders or files, or where
        they are placed in different numbers of files."""
        buckets = {e.buckets for e in entries}
        if not spec.placed_by or len(buckets) > 1 or 0 in buckets or len({e.slice for e in entries}) < len(entries):
            return None
        name, rows = self._named(spec, schema, entries)
        self._views.append(name)
        return rows

    def _named(self, spec: Stored, schema: T.StructType, entries: Sequence[Entry]) -> tuple[str, DataFrame]:
        """Entries placed in the same number of files as a table of the session's catalog."""
        name = f"stored_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        sliced = f"partitioned by ({', '.join(spec.slices)})" if spec.slices else ""
        where = f"{self.root}/{entries[0].path}" if not spec.slices else f"{self.root}/_views/{name}"
        self.spark.sql(
            f"create table {name} ({columns}) using parquet {sliced} "
            f"clustered by ({spec.placed_by}) into {entries[0].buckets} buckets location '{where}'"
        )
        if spec.slices:
            self.spark.sql(f"alter table {name} add " + " ".join(f"partition ({_literals(e)}) location '{self.root}/{e.path}'" for e in entries))
        return name, self.spark.table(name).select(*schema.names)

    def forget(self) -> None:
        """Drops the session's names of tables read; files stay."""
        for name in self._views:
            self.spark.sql(f"drop table if exists {name}")
        self._views = []

    # --- writing ----------------------------------------------------------------

    def commit(self, *changes: Change) -> int:
        """Writes the files of all changes, then one record; returns its number.

        Each table may change once.  Fails without a record if any change fails, and before
        any row is written if files that stay do not fit their table's declared schema.
        """
        names = [c.table for c in changes]
        if len(set(names)) < len(names):
            raise ValueError(f"several changes of one table: {names}")
        before = self.entries()
        after = [e for e in before if e.table not in names]
        for table, schema in dict.fromkeys((e.table, e.schema) for e in before if e.table in names):
            if not any(isinstance(c, ReplaceAll) and c.table == table for c in changes):
                check(T.StructType.fromJson(json.loads(schema)), self.tables[table].schema, table)
        for change in changes:
            after += self._changed(change, [e for e in before if e.table == change.table])
        return self._record(after)

    def _changed(self, change: Change, before: list[Entry]) -> list[Entry]:
        if isinstance(change, ReplaceAll):
            return self._staged(change.table, change.rows)
        if isinstance(change, Add):
            rows = change.rows
            if change.key:
                rows = missing_from(rows.dropDuplicates([change.key]), self.read(change.table), F.col(change.key), F.col(change.key))
            return before + self._staged(change.table, rows)
        if isinstance(change, Update):
            return self._updated(change, before)
        unknown = {c for owned in change.owned for c in owned} - set(self.tables[change.table].slices)
        if unknown:
            raise ValueError(f"{change.table} has no slice columns {sorted(unknown)}")
        staged = self._staged(change.table, change.rows)
        outside = [e.slice for e in staged if not any(e.within(owned) for owned in change.owned)]
        if outside:
            raise ValueError(f"rows of {change.table} outside of the slices replaced: {outside[:5]}")
        return [e for e in before if not any(e.within(owned) for owned in change.owned)] + staged

    def _staged(self, table: str, rows: DataFrame) -> list[Entry]:
        """``rows`` in files that no record names yet, with ids reserved for them.

        Ids follow the places of rows in files, so rows are written without ids first.
        Rows of a placed table lie in their buckets from then on: the files with ids need
        no shuffle, and what the first ones shuffled is deleted before them.
        """
        spec = self.tables[table]
        if not spec.ids:
            return self._written(table, conform(rows, spec.schema))
        plain = T.StructType([f for f in spec.schema.fields if f.name != spec.ids])
        if not spec.placed_by:
            kept = Intermediate()
            numbered = self.numbered(table, kept(conform(rows, plain), f"{table}-without-ids"))
            entries = self._written(table, conform(numbered, spec.schema))
            kept.clear()
            return entries
        first = self._files(table, conform(rows, plain))
        if not first:
            return []
        name, placed = self._named(spec, plain, first)
        entries = self._written(table, conform(self.numbered(table, placed), spec.schema), True)
        self.spark.sql(f"drop table {name}")
        self.files.delete(f"{self.root}/{'/'.join(first[0].path.split('/')[:2])}")
        return entries

    def _written(self, table: str, rows: DataFrame, lie: bool = False) -> list[Entry]:
        """The files that a record is to name."""
        return self._files(table, rows, lie)

    def _files(self, table: str, rows: DataFrame, lie: bool = False) -> list[Entry]:
        """``rows`` in a new folder; if they ``lie`` in the table's buckets, as a scan of
        placed files gives them, they are not shuffled."""
        spec = self.tables[table]
        top = f"{table}/{CHANGE}={uuid.uuid4().hex}"
        with settings(self.spark, {**RELEASED, **BY_BUCKET}):
            if spec.placed_by:
                # one task a bucket, so a bucket of a slice is one file
                rows = rows if lie else rows.repartition(spec.buckets, spec.placed_by)
                writer = rows.write.partitionBy(*spec.slices)
                name = f"staged_{uuid.uuid4().hex}"
                writer = writer.bucketBy(spec.buckets, spec.placed_by).option("path", f"{self.root}/{top}")
                writer = writer.option("compression", CODEC)
                writer.format("parquet").mode("errorifexists").saveAsTable(name)
                self.spark.sql(f"drop table {name}")
            else:
                writer = rows.write.mode("errorifexists").partitionBy(*spec.slices)
                writer.option("compression", CODEC).parquet(f"{self.root}/{top}")
        slices = self.files.folders(f"{self.root}/{top}", len(spec.slices))
        buckets = spec.buckets if spec.placed_by else 0
        return [Entry(table, s, f"{top}/{s}".rstrip("/"), rows.schema.json(), buckets) for s in slices]

    def _updated(self, change: Update, before: list[Entry]) -> list[Entry]:
        """Copy on write: the files that hold a key of the updates are replaced."""
        hit = self.files_with(change.table, change.updates, change.key)
        if not hit:
            return before
        rest, old = [], []
        for e in before:
            inside = [e.path] if _is_file(e.path) else [f"{e.path}/{n}" for n in self.files.data_files(f"{self.root}/{e.path}")]
            if not any(path in hit for path in inside):
                rest.append(e)
                continue
            parts = [replace(e, path=path, buckets=0) for path in inside]
            rest += [p for p in parts if p.path not in hit]
            old += [p for p in parts if p.path in hit]
        declared = self.tables[change.table].schema
        rows = [
            reconcile(self._plain(change.table, T.StructType.fromJson(json.loads(schema)), [e for e in old if e.schema == schema]), declared, change.table)
            for schema in dict.fromkeys(e.schema for e in old)
        ]
        whole = rows[0]
        for part in rows[1:]:
            whole = whole.union(part)
        merged = merge_columns(whole, change.updates, change.key, change.columns)
        return rest + self._written(change.table, conform(merged, declared))

    def files_with(self, table: str, keys: DataFrame, key: str) -> set[str]:
        """The table's files, relative to the root, that hold a key of ``keys``.

        Reads the key column of the table; only names of files reach the driver.
        """
        found: set[str] = set()
        wanted = keys.select(F.col(key).alias("_wanted")).distinct()
        wanted = F.broadcast(wanted) if fits_in_broadcast(wanted) else wanted
        entries = self._entries_of(table)
        for schema in dict.fromkeys(e.schema for e in entries):
            stored = T.StructType.fromJson(json.loads(schema))
            held = self._plain(table, stored, [e for e in entries if e.schema == schema], F.col("_metadata.file_path").alias("_file"))
            hit = held.select(key, "_file").join(wanted, F.col(key) == F.col("_wanted"), "left_semi")
            found |= {_relative(r[0], table) for r in hit.select("_file").distinct().collect()}
        return found

    # --- ids --------------------------------------------------------------------

    def reserve(self, table: str, n: int) -> int:
        """The first of ``n`` ids above all that were ever reserved or stored.

        A block is one empty file that carries both ends in its name, made before any
        row is written: what a crash leaves behind it is never given out again.
        """
        start = self.largest_id(table) + 1
        if n:
            self.files.create(f"{self.root}/{IDS}/{table}/{start:020d}-{start + n - 1:020d}")
        return start

    def largest_id(self, table: str) -> int:
        """0 for a table without rows; the id column is read if no block was ever reserved."""
        blocks = self.files.names(f"{self.root}/{IDS}/{table}")
        if blocks:
            return max(int(name.partition("-")[2]) for name in blocks)
        found = self.read(table).agg(F.max(F.col(self.tables[table].ids).cast("long"))).first()[0]
        return found or 0

    def numbered(self, table: str, rows: DataFrame) -> DataFrame:
        """``rows``, a Parquet scan, with ids of a new block and no gaps.

        A file's ids begin after those of the files before it, and follow the rows in the
        file, so a task that runs again gives the same ones.
        """
        counts = rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n")).orderBy("path").collect()
        first = self.reserve(table, sum(r.n for r in counts))
        offsets = []
        for r in counts:  # one for each file
            offsets.append((r.path, first))
            first += r.n
        begins = self.spark.createDataFrame(offsets, "_path string, _first long")
        located = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        begins = F.broadcast(begins) if fits_in_broadcast(begins) else begins
        joined = located.join(begins, F.col("_file") == F.col("_path"))
        return joined.withColumn(self.tables[table].ids, F.col("_first") + F.col("_row")).drop("_path", "_first", "_file", "_row")

    # --- old files --------------------------------------------------------------

    def vacuum(self, keep: int = 2) -> int:
        """Deletes the files that none of the ``keep`` newest commits names, and older
        records; returns the number of folders and files deleted.  Readers of older
        commits and a close that is being written must be done."""
        complete = sorted(n for n, done in self._versions().items() if done)[-keep:]
        named = {e.path for n in complete for e in self.entries(n)}
        gone = 0
        for n in self._versions():
            if n not in complete:
                gone += self.files.delete(f"{self.root}/{COMMITS}/version={n}")
        for table in self.tables:
            for change in self.files.names(f"{self.root}/{table}"):
                top = f"{table}/{change}"
                if any(path == top or path.startswith(f"{top}/") for path in named):
                    gone += self._thinned(top, named)
                else:
                    gone += self.files.delete(f"{self.root}/{top}")
        return gone

    def _thinned(self, top: str, named: set[str]) -> int:
        """Deletes what no record names inside a change's folder that some record names."""
        if top in named:
            return 0
        gone = 0
        for name in self.files.names(f"{self.root}/{top}"):
            path = f"{top}/{name}"
            if any(p.startswith(f"{path}/") for p in named):
                gone += self._thinned(path, named)
            elif path not in named:
                gone += self.files.delete(f"{self.root}/{path}")
        return gone


def _is_file(path: str) -> bool:
    return path.endswith(".parquet")


def _relative(file_path: str, table: str) -> str:
    """A file's path below the root, from its address in any file system."""
    return f"{table}/{CHANGE}=" + file_path.rpartition(f"/{CHANGE}=")[2]


def _literals(entry: Entry) -> str:
    quoted = ((c, "null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'") for c, v in entry.values().items())
    return ", ".join(f"{c} = {v}" for c, v in quoted)
