"""Intermediate tables that several results are computed from."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_named: dict[str, str] = {}  # by application


def name_folder(spark: SparkSession, folder: str) -> None:
    """The shared folder of a session that was started without ``spark.checkpoint.dir``."""
    _named[spark.sparkContext.applicationId] = folder


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or _named.get(spark.sparkContext.applicationId)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


WIDE_ROWS = {
    "spark.sql.codegen.maxFields": "1000",
    # rows that lie by product can be joined by product and customer where they are
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
CODEC = "zstd"  # of the files written: a third smaller than Spark's default
SHUFFLES = "spark.sql.shuffle.partitions"
# what a write has shuffled is deleted with its end, not when the driver next collects garbage
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class Files:
    """Folders and files of any file system that Spark knows."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        system, where = self._at(path)
        return system.exists(where)

    def delete(self, path: str) -> bool:
        system, where = self._at(path)
        return system.delete(where, True)

    def create(self, path: str) -> None:
        """An empty file; an error if there is one."""
        system, where = self._at(path)
        if not system.createNewFile(where):
            raise FileExistsError(path)

    def names(self, folder: str) -> list[str]:
        """What is in a folder; nothing if there is none."""
        system, where = self._at(folder)
        if not system.exists(where):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(where))

    def data_files(self, folder: str) -> list[str]:
        return [name for name in self.names(folder) if name.endswith(".parquet")]

    def folders(self, top: str, depth: int) -> list[str]:
        """The folders of partitions ``depth`` levels below ``top``, by their path from it."""
        found = [""]
        for _ in range(depth):
            found = [f"{above}/{name}".lstrip("/") for above in found for name in self.names(f"{top}/{above}") if "=" in name]
        return found


class Intermediate:
    """Tables written once and read back, and deleted when they are not needed any more.

    Results derived from one do not recompute what came before, read only the
    columns they need, and survive the loss of executors.  With a ``key`` that stands for
    all inputs, a later session finds the tables that an earlier one completed; each is
    complete once its ``_SUCCESS`` file is there.
    """

    def __init__(self, key: str | None = None) -> None:
        self.key = key
        self.paths: list[tuple[SparkSession, str]] = []

    def __call__(self, df: DataFrame, name: str, parts: int = 0) -> DataFrame:
        """``df`` written, unless it was already, and read back.  Accounts have more
        columns than Spark compiles into one loop by default, so that limit is raised.
        ``parts``: of a shuffle, if not as many as the session has."""
        spark = df.sparkSession
        folder = shared_folder(spark)
        if self.key:
            path = f"{folder}/close-{self.key}/{name}"
        else:
            path = f"{folder}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        self.paths.append((spark, path))
        if not (self.key and Files(spark).exists(f"{path}/_SUCCESS")):
            with settings(spark, {**WIDE_ROWS, **RELEASED, **({SHUFFLES: str(parts)} if parts else {})}):
                df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def release(self, first: int, last: int) -> None:
        """Deletes the tables in these places of ``paths``, which no result reads any more.
        With a ``key`` they stay, as a later session looks for them."""
        if self.key is None:
            for spark, path in self.paths[first:last]:
                Files(spark).delete(path)
            del self.paths[first:last]

    def clear(self) -> None:
        for spark, path in self.paths:
            Files(spark).delete(path)
        self.paths = []
