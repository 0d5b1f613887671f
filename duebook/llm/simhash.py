"""SimHash near duplicates, candidates by the pigeonring principle.

A fingerprint of 64 bits is cut into ``distance + 1`` segments on a ring.  If two
fingerprints differ in at most ``distance`` bits, there is a segment from which
every chain of ``l`` consecutive segments differs in at most
``l * distance / (distance + 1)`` bits, so in ``l - 1`` at most (Qin and Xiao,
"Pigeonring", VLDB 2018).  Chains of two segments are met by an equality join
(the first segment equal, the second up to one bit), longer chains and then the
whole distance are checked on each candidate.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, tasks
from .components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
_AT_ONCE = 1 << 16


def _bit_sums(bits: np.ndarray) -> np.ndarray:
    """Column sums of a 0/1 byte matrix, in blocks of 255 rows that fit in a byte."""
    full = len(bits) // 255 * 255
    sums = bits[full:].sum(axis=0, dtype=np.uint8).astype(np.int64)
    return sums + bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprint_of(text: bytes | None, size: int = SHINGLE) -> int:
    """The fingerprint as a signed long: majority bits of the XXH64 of all shingles.

    A-Z are lower-cased.  Fewer words than ``size`` are one shingle; no words
    (or a null text) give zero.
    """
    from xxhash import xxh64_intdigest

    found = text.lower().split() if text else []
    if not found:
        return 0
    size = min(size, len(found))
    n = len(found) - size + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, _AT_ONCE):
        part = found[start : min(n, start + _AT_ONCE) + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False))
        hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")
        ones += _bit_sums(np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64))
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([fingerprint_of(x.as_buffer().to_pybytes() if x.is_valid else None, size) for x in batch.cast(pa.large_binary())], pa.int64())

    return F.arrow_udf(batches, "long")(text.cast("string"))


def as_hex(print_: Column) -> Column:
    return F.lpad(F.lower(F.hex(print_)), 16, "0")


def _segments(distance: int) -> list[int]:
    """Bit masks of the segments."""
    edges = [round(64 * k / (distance + 1)) for k in range(distance + 2)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints of ``prints`` (column
    ``fingerprint``) that differ in 1 to ``distance`` bits, each once or more."""
    if distance == 0:
        return prints.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).where(F.lit(False))
    rings = _segments(distance)
    m = len(rings)
    spread = prints.select("fingerprint").repartition(tasks(prints.sparkSession), "fingerprint")
    own, near, fits = [], [], F.lit(False)
    differ = F.col("a").bitwiseXOR(F.col("b"))
    for i, first in enumerate(rings):
        second = rings[(i + 1) % m]
        key = F.col("fingerprint").bitwiseAND(F.lit(_signed(first | second)))
        own.append(F.struct(F.lit(i).alias("ring"), key.alias("key")))
        flips = [0] + [1 << j for j in range(64) if second >> j & 1]
        near += [F.struct(F.lit(i).alias("ring"), key.bitwiseXOR(F.lit(_signed(x))).alias("key")) for x in flips]
        chain, within = 0, F.lit(True)
        for length in range(1, m + 1):
            chain |= rings[(i + length - 1) % m]
            within &= F.bit_count(differ.bitwiseAND(F.lit(_signed(chain)))) <= length - 1
        fits |= (F.col("p.ring") == i) & within
    probe = spread.select(F.col("fingerprint").alias("a"), F.inline(F.array(*near))).alias("p")
    index = spread.select(F.col("fingerprint").alias("b"), F.inline(F.array(*own))).alias("q")
    meets = (F.col("p.ring") == F.col("q.ring")) & (F.col("p.key") == F.col("q.key"))
    return probe.join(index, meets & (F.col("a") < F.col("b")) & fits & (F.bit_count(differ) <= distance)).select("a", "b")


def _grouped(docs: DataFrame, size: int, distance: int) -> DataFrame:
    """Every row's id, a hash of its text, its fingerprint and component."""
    scratch = Scratch(docs.sparkSession)
    text = F.col("text").cast("string")
    each = scratch.cut(docs.select("doc_id", F.xxhash64(text).alias("hash"), fingerprint(text, size).alias("fingerprint")))
    nodes = scratch.cut(each.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes, distance), "a", "b").withColumnRenamed("node", "fingerprint")
    nodes = scratch.cut(nodes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint")))
    least = scratch.cut(nodes.groupBy("root").agg(F.min("first").alias("component_id")))
    nodes = scratch.cut(nodes.join(least, "root").select("fingerprint", "root", "component_id"))
    return each.join(nodes, "fingerprint")


def simhash_groups(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long), ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable by links.  Equal
    fingerprints are one node, however many rows have them.  Rows without a
    ``doc_id`` take part; a component of such rows alone has a null id.  Repeated
    rows come out as often as they came in; an empty table gives an empty table.
    """
    return _grouped(docs, size, distance).select("doc_id", "fingerprint", "component_id")


def simhash_dedup(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group of near duplicates, with all columns of ``docs``.

    The row with the smallest ``doc_id`` stays; of several rows with that id the
    one whose text has the smallest hash, and one of equal rows.  The same holds
    in a group in which no row has an id.
    """
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = _grouped(docs, size, distance).where(first).groupBy("root").agg(F.min("doc_id").alias("doc_id"), F.min("hash").alias("hash"))
    rows = docs.select(F.struct("*").alias("row"), *_key(F.col("doc_id"), F.xxhash64(F.col("text").cast("string"))))
    left = rows.join(kept.select(*_key(F.col("doc_id"), F.col("hash"))), ["id", "no_id", "hash"], "left_semi")
    return left.groupBy("id", "no_id", "hash").agg(F.first("row").alias("row")).select("row.*")


def _key(doc_id: Column, text_hash: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id"), text_hash.alias("hash")]
