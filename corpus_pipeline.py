"""A training corpus from the documents: filters, dedup, packing.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.llm.common import Scratch
from duebook.llm.line_dedup import line_dedup
from duebook.llm.packing import pack
from duebook.llm.quality import quality_filter
from duebook.llm.simhash import simhash_dedup
from duebook.llm.toxicity import toxicity_filter

ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject."""
    return toxicity_filter(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; a document of which nothing is left goes."""
    count = "lines_removed" + "_" * max(map(len, docs.columns))  # no column of docs has this name
    left = line_dedup(docs, count=count).where((F.col(count) == 0) | (F.col("text") != ""))
    n_chars = F.when(F.col(count) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup(docs, size=3, distance=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of the documents left."""
    return pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("quality rules", low_quality),
    ("line dedup", repeated_lines),
    ("near duplicates", near_duplicates),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.  The table of a stage is deleted once
    the next one is written."""
    before = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        now = Scratch(spark)
        docs = now.cut(stage(spark, docs, sf_dir))
        before.clear()
        before = now
    return STAGES[-1][1](spark, docs, sf_dir)
