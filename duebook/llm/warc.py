"""Web archive records and the resolution of not-modified revisits.

A revisit of status 304 has no body: it says that the page is what an earlier
capture held.  It is resolved by an as-of join on the canonical URL to the latest
earlier full response.  The response must have the validator that the revisit
names; then its headers, updated by those that a 304 may change, and its payload
are the revisit's.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, tasks

# Headers that a 304 response may update (RFC 9110, 15.4.5, and RFC 9111, 3.2).
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")

_READ = 1 << 16  # bytes unpacked at a time
_BATCH = 1 << 25  # bytes of payload in a batch

RECORD = (
    "record_id string, warc_type string, url string, date timestamp, status int, headers map<string,string>, payload binary"
)


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case (A-Z), without default port and fragment; an empty
    path is ``/``.  Null for what is not a URL."""
    part = [F.regexp_extract(url, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)([^#]*)", i) for i in range(1, 5)]
    scheme, host = (F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") for x in part[:2])
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    path = F.when(part[2] == "", "/").otherwise(part[2])
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), host, path, part[3]))


def _opaque(etag: Column) -> Column:
    """For weak comparison."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


def as_of(records: DataFrame) -> DataFrame:
    """``record_id`` of each revisit and ``refers_to``, the latest earlier full response.

    ``records`` has record_id, key (canonical URL), date, full and revisit (booleans).
    Rows are sorted by URL and date over ranges, so a URL with very many captures
    takes several partitions; each partition hands on the last response it has of a
    URL, one row for a partition and URL.
    """
    scratch = Scratch(records.sparkSession)
    rank = F.when(F.col("full"), 1).otherwise(0)  # a response at the same time is not earlier
    rows = records.where("(full or revisit) and key is not null and date is not null")
    order = ["key", "date", "rank", "record_id"]
    sorted_ = rows.withColumn("rank", rank).repartitionByRange(tasks(records.sparkSession), *order).sortWithinPartitions(*order)
    parted = scratch.cut(sorted_.select(F.spark_partition_id().alias("part"), *order, "revisit"))
    response = F.when(~F.col("revisit"), F.col("record_id"))
    inside = Window.partitionBy("part", "key").orderBy("date", "rank", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    near = parted.select("part", *order, "revisit", F.last(response, ignorenulls=True).over(inside).alias("near")).where("revisit")
    ends = parted.where("not revisit").groupBy("part", "key").agg(F.max_by("record_id", F.struct("date", "record_id")).alias("end"))
    parts = parted.select("part", "key").distinct().join(ends, ["part", "key"], "left")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    handed = parts.select("part", "key", F.last("end", ignorenulls=True).over(before).alias("handed")).where("handed is not null")
    found = near.join(handed, ["part", "key"], "left")
    return found.select("record_id", F.coalesce("near", "handed").alias("refers_to"))


def resolve_revisits(records: DataFrame, carry: tuple[str, ...] = ("payload",)) -> DataFrame:
    """All records with ``outcome``, ``refers_to``, merged ``headers`` and the columns
    ``carry`` of the response for resolved revisits.

    ``records`` has record_id (unique; repeats are taken for the same record), url,
    date, warc_type, status, headers (lower-case names) and the columns of ``carry``.
    Outcomes: ``full`` (a response of status 200), ``resolved``, ``mismatch`` (the
    latest earlier response has another validator), ``no validator``, ``orphan`` (no
    earlier response, or no usable url or date) and ``other``.  Of several responses
    at the same time the one with the largest id is the latest.  Only resolved
    revisits change; an empty table gives an empty table.
    """
    scratch = Scratch(records.sparkSession)
    kind = F.col("warc_type")
    slim = records.select(
        "record_id",
        canonical_url(F.col("url")).alias("key"),
        "date",
        F.coalesce((kind == "response") & (F.col("status") == 200), F.lit(False)).alias("full"),
        F.coalesce((kind == "revisit") & (F.col("status") == 304), F.lit(False)).alias("revisit"),
    )
    pairs = scratch.cut(as_of(slim).where("refers_to is not null").dropDuplicates(["record_id"]))
    wanted = [F.col("headers").alias("old"), *(F.col(c).alias(f"old_{i}") for i, c in enumerate(carry))]
    responses = records.where((kind == "response") & (F.col("status") == 200)).select(F.col("record_id").alias("refers_to"), *wanted)
    used = scratch.cut(pairs.select("refers_to").distinct())
    old = scratch.cut(responses.join(used, "refers_to").dropDuplicates(["refers_to"]))
    joined = records.join(pairs, "record_id", "left").join(old, "refers_to", "left")
    new_tag, new_time = F.col("headers")["etag"], F.col("headers")["last-modified"]
    same = F.when(new_tag.isNotNull(), _opaque(new_tag) == _opaque(F.col("old")["etag"])).otherwise(F.trim(new_time) == F.trim(F.col("old")["last-modified"]))
    revisit = F.coalesce((kind == "revisit") & (F.col("status") == 304), F.lit(False))
    outcome = (
        F.when(F.coalesce((kind == "response") & (F.col("status") == 200), F.lit(False)), "full")
        .when(~revisit, "other")
        .when(F.col("refers_to").isNull(), "orphan")
        .when(new_tag.isNull() & new_time.isNull(), "no validator")
        .when(F.coalesce(same, F.lit(False)), "resolved")
        .otherwise("mismatch")
    )
    marked = joined.withColumn("outcome", outcome)
    done = F.col("outcome") == "resolved"
    allowed = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    stays = F.map_filter("old", lambda k, _: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False)))
    merged = F.when(done, F.map_concat(stays, allowed)).otherwise(F.col("headers"))
    return marked.select(
        "record_id", "url", "date", "warc_type", "status", "outcome",
        F.when(done, F.col("refers_to")).alias("refers_to"),
        merged.alias("headers"),
        *(F.when(done, F.col(f"old_{i}")).otherwise(F.col(c)).alias(c) for i, c in enumerate(carry)),
    )


def parse_warc(data: bytes) -> Iterator[dict]:
    """The records of uncompressed archive bytes; a broken tail ends them."""
    at = data.find(b"WARC/")
    while at >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        fields = _headers(data[at:end].split(b"\r\n")[1:])
        length = int(fields.get("content-length") or 0) if (fields.get("content-length") or "0").isdigit() else 0
        block = data[end + 4 : end + 4 + length]
        if len(block) < length:
            return
        status, headers, payload = None, {}, block
        if block.startswith(b"HTTP/"):
            head, _, payload = block.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            code = lines[0].split()[1:2]
            status = int(code[0]) if code and code[0].isdigit() else None
            headers = _headers(lines[1:])
        yield {
            "record_id": fields.get("warc-record-id"), "warc_type": fields.get("warc-type"), "url": fields.get("warc-target-uri"),
            "date": fields.get("warc-date"), "status": status, "headers": headers, "payload": payload,
        }
        at = data.find(b"WARC/", end + 4 + length)


def _headers(lines: list[bytes]) -> dict[str, str]:
    """Names in lower case; a repeated header's values are joined by commas."""
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            key = name.strip().lower()
            out[key] = f"{out[key]}, {value.strip()}" if key in out else value.strip()
    return out


def members(data: bytes) -> Iterator[bytes]:
    """The bytes themselves, or those of each gzip member, of which an archive has one a
    record; a broken member ends them."""
    if not data.startswith(b"\x1f\x8b"):
        yield data
        return
    view, at = memoryview(data), 0
    while at < len(view):
        member, parts = zlib.decompressobj(wbits=31), []
        try:
            while not member.eof and at < len(view):
                parts.append(member.decompress(view[at : at + _READ]))
                at += min(_READ, len(view) - at) - len(member.unused_data)
        except zlib.error:
            return
        if not member.eof:
            return
        yield b"".join(parts)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of archive files, plain or gzip, a file (2 GB at most) to a task.

    Records of a gzip file are unpacked one at a time, and rows are handed on whenever
    their payloads reach ``_BATCH`` bytes.
    """
    names = ("record_id", "warc_type", "url", "date", "status", "headers", "payload")
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()), pa.binary())

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([list(r[n].items()) if n == "headers" else r[n] for r in rows], t) for n, t in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, list(names))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for member in members(content.as_py() or b""):
                    for record in parse_warc(member):
                        rows.append(record)
                        size += len(record["payload"])
                        if size > _BATCH:
                            yield batch_of(rows)
                            rows, size = [], 0
                yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    raw = files.mapInArrow(parsed, RECORD.replace("date timestamp", "date string"))
    return raw.withColumn("date", F.to_timestamp("date"))
