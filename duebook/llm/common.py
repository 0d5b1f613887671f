"""Helpers of the operators: intermediate tables, words, bound expressions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
WORD_GAP = r"[\x20\x09-\x0D]+"

_local_folders: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A session on a local master that has none gets a temporary folder of its
    own; on a cluster the setting is required.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="llm-")
    return _local_folders[app]


class Scratch:
    """Tables written to the shared folder, so that lost executors cost one stage."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def cut(self, df: DataFrame) -> DataFrame:
        """``df`` written as Parquet and read back."""
        path = f"{folder(self.spark)}/llm-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Deletes the tables; only for those that no later result reads."""
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(hadoop).delete(where, True)
        self.paths = []


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once a row, also inside lambdas."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words(text: Column) -> Column:
    """The runs of characters other than the six ASCII white spaces; null gives none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE)) != ""


def n_tasks_for(total: int, each: int) -> int:
    return max(1, -(-total // each))
