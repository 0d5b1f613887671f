"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .common import Scratch
from .embedding import embedding_groups
from .html_text import main_text
from . import alignment, conversations, language
from .line_dedup import line_dedup
from .packing import pack
from .pieces import sampled_pieces
from .quality import base_failed, features, fit_quality, kept
from .simhash import as_hex, simhash_groups
from .toxicity import HELD_OUT, REJECT, fit_toxicity, fold
from .url_filter import host_and_path, url_filter
from .warc import resolve_revisits


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    counted = Scratch(spark).cut(docs.select("doc_id", features(F.col("text")).alias("features")))
    model, x = fit_quality(counted), F.col("features")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return counted.select(
        "doc_id", *(x[c].alias(c) for c in names), base_failed(x).alias("base_failed"), kept(model, x).alias("kept"),
        model.posterior(x).alias("posterior"),
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = fit_toxicity(docs, _read(spark, sf_dir, "labels")).scored(docs.select("doc_id", "text"))
    held_out = F.coalesce(fold(F.col("row.doc_id")) == HELD_OUT, F.lit(False))
    found = scored.select("row.doc_id", held_out.alias("held_out"), "score")
    return found.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


def op5_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_pieces(_read(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(_read(spark, sf_dir, "embeddings"))


def captures(pages: DataFrame) -> DataFrame:
    """Four captures of each page: a full response, then revisits and responses whose
    validators follow from the page's number; some pages have a revisit before all."""
    p, k = F.col("page_id"), F.col("k")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    full = (k == 0) | ((k == 2) & (p % 3 == 0))
    body = F.when(k == 0, F.col("html")).otherwise(F.concat("html", F.lit("<!-- 2 -->")))
    first = F.concat(F.lit("Mon, 01 Jan 2024 00:00:"), F.lpad((p % 60).cast("string"), 2, "0"), F.lit(" GMT"))
    etag = F.when(k == 0, tag).when((k == 1) & (p % 5 == 0), '"other"').when(k == 1, tag).when(k >= 3, F.concat(F.lit("W/"), tag))
    changed = F.when(k == 0, first).when((k == 2) & ((p % 2 == 0) | full), first)
    headers = F.map_filter(
        F.create_map(
            F.lit("etag"), etag, F.lit("last-modified"), changed,
            F.lit("cache-control"), F.when(k > 0, F.concat(F.lit("max-age="), k.cast("string"))).otherwise("no-cache"),
            F.lit("content-type"), F.when(full, "text/html").otherwise("text/plain"),
            F.lit("server"), F.when(full, "origin"),
        ),
        lambda _, v: v.isNotNull(),
    )
    rows = pages.select("page_id", "url", "html", F.explode(F.when(p % 11 == 0, F.expr("array(0, 1, 2, 3, -1)")).otherwise(F.expr("array(0, 1, 2, 3)"))).alias("k"))
    return rows.select(
        F.concat(F.lit("urn:"), p.cast("string"), F.lit(":"), k.cast("string")).alias("record_id"),
        F.when(full, "response").otherwise("revisit").alias("warc_type"),
        "url",
        F.timestamp_seconds(F.lit(1704067200) + (p % 1000) * 60 + k * 86400).alias("date"),
        F.when(full, 200).otherwise(304).alias("status"),
        headers.alias("headers"),
        F.when(full, F.md5(body)).alias("payload_md5"),
        F.when(full, F.length(body).cast("long")).alias("payload_chars"),
    )


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_revisits(captures(_read(spark, sf_dir, "pages")), carry=("payload_md5", "payload_chars"))
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda x: F.concat(x["key"], F.lit(": "), x["value"])))
    return found.select("record_id", "outcome", "refers_to", F.array_join(pairs, "\n").alias("headers"), "payload_md5", "payload_chars")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_read(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(_read(spark, sf_dir, "documents"))
    return groups.select("doc_id", as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document that its path names, so that document's quality
    label is the page's outcome."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    marked = _read(spark, sf_dir, "labels").where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("good"))
    shown = F.regexp_extract(host_and_path(F.col("url"))[1], r"^/[^/]*/([0-9]+)", 1)
    outcomes = pages.select("url", shown.try_cast("long").alias("doc_id")).join(marked, "doc_id", "left")
    return url_filter(pages, outcomes.select("url", "good"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language.fold(F.col("doc_id")) == language.HELD_OUT, F.lit(False))
    return language.identify_language(docs).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows of which some are dropped, emptied, cut, repeated or given
    another role, by a hash of conversation and turn."""
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    plain = rows.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")), (F.crc32(named) % 20).alias("draw"))
    times = F.when(F.col("draw") == 3, F.expr("array(1, 2)")).otherwise(F.expr("array(1)"))
    draw, text = F.col("draw"), F.col("text")
    return plain.where(draw != 0).select(
        "conv_id", "turn", F.when(draw == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), F.explode(times).alias("time"),
    ).drop("time")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations")
    found = conversations.report(conversations.repair(damaged(rows))).withColumnRenamed("conv_id", "id")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return every.select("conv_id", *(F.coalesce(c, F.lit(none.get(c, 0))).alias(c) for c in found.columns if c != "id"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link(_read(spark, sf_dir, "documents")).documents


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_sentencepiece_sampling": op5_sentencepiece_sampling,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_html_text": op8_html_text,
    "op9_simhash": op9_simhash,
    "op10_url_filters": op10_url_filters,
    "op11_language_id": op11_language_id,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

SQL: dict[str, str] = {
    "op1_line_dedup": sql.LINE_DEDUP,
    "op7_warc_revisits": sql.WARC,
    "op10_url_filters": sql.URL_FILTER,
}
