"""Removal of passages that repeat: overlapping windows of three lines.

Lines with a word are hashed, trimmed, to 128 bits; every three consecutive ones
are a window.  A window's first occurrence is the one with the smallest
(``doc_id``, position); lines covered by any later occurrence go, together with
blank lines between covered ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, has_word, let

WINDOW = 3


def _windows(text: Column, size: int) -> Column:
    """Array of (w, v, pos, again): hash, position among the lines with a word,
    and whether the window stood earlier in the same text."""

    def hashed(lines: Column) -> Column:
        def window(i: Column) -> Column:
            at = [F.get(lines, i + k) for k in range(size)]
            return F.struct(F.xxhash64(*(x["a"] for x in at)).alias("w"), F.xxhash64(*(x["b"] for x in at)).alias("v"), i.alias("pos"))

        found = F.transform(F.sequence(F.lit(0), F.size(lines) - size), window)
        return F.when(F.size(lines) >= size, F.array_sort(found))

    def marked(found: Column) -> Column:
        def mark(x: Column, i: Column) -> Column:
            before = F.get(found, i - 1)
            again = (i > 0) & (before["w"] == x["w"]) & (before["v"] == x["v"])
            return F.struct(x["w"].alias("w"), x["v"].alias("v"), x["pos"].alias("pos"), F.coalesce(again, F.lit(False)).alias("again"))

        return F.transform(found, mark)

    bare = F.transform(F.filter(F.split(text, "\n"), has_word), lambda x: F.btrim(x, F.lit(SPACE)))
    lines = F.transform(bare, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")))
    return let(let(lines, hashed), marked)


def _without(text: Column, starts: Column, size: int) -> Column:
    """(text, removed): ``text`` without the lines that windows at ``starts``
    (sorted, distinct) cover, and how many lines with a word that were.

    Overlapping and adjacent windows are merged, then the gaps between the merged
    ranges are joined, so the work grows with the lines and not with their square.
    """

    def cut(x: Column) -> Column:
        lines, at, begins, ends = x["lines"], x["at"], x["begins"], x["ends"]
        n = F.size(begins)

        def gap(k: Column) -> Column:
            low = F.when(k == 0, F.lit(0)).otherwise(F.get(at, F.get(ends, k - 1)) + 1)
            high = F.when(k == n, F.size(lines)).otherwise(F.get(at, F.get(begins, k)))
            return F.slice(lines, low + 1, F.greatest(high - low, F.lit(0)))

        left = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n), gap)), "\n")
        removed = F.aggregate(F.zip_with(begins, ends, lambda b, e: e - b + 1), F.lit(0), lambda a, b: a + b)
        return F.struct(left.alias("text"), removed.alias("removed"))

    begins = F.filter(starts, lambda x, i: (i == 0) | (x > F.get(starts, i - 1) + size))
    ends = F.transform(
        F.filter(starts, lambda x, i: (i == F.size(starts) - 1) | (F.get(starts, i + 1) > x + size)),
        lambda x: x + (size - 1),
    )

    def parts(lines: Column) -> Column:
        numbered = F.transform(lines, lambda x, i: F.when(has_word(x), i))
        at = F.filter(numbered, lambda x: x.isNotNull())
        return F.struct(lines.alias("lines"), at.alias("at"), begins.alias("begins"), ends.alias("ends"))

    return let(let(F.split(text, "\n"), parts), cut)


def line_dedup(docs: DataFrame, size: int = WINDOW, count: str = "lines_removed") -> DataFrame:
    """``docs`` with ``text`` without repeated passages and the number of lines with a
    word that went (column ``count``).

    A window is later if its ``doc_id`` is not the smallest that has it, or if it
    stood earlier in the same row.  Rows sharing a ``doc_id`` count as one
    document and do not remove each other's lines; rows without an id come last,
    as one document.  Texts of fewer than ``size`` lines with a word, empty and
    null ones, are left alone; a text of which every line goes becomes empty.
    A column ``count`` of ``docs`` is replaced.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.col("text")
    key = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit(1), text).alias("u")]
    found = scratch.cut(docs.select("doc_id", *key, F.inline(_windows(text, size))))
    repeated = scratch.cut(
        found.groupBy("w", "v").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("w", "v", "first")
    )
    spot = ["id", "no_id", "t", "u", "pos"]
    later = found.where("not again").join(repeated, ["w", "v"]).where(~F.col("doc_id").eqNullSafe(F.col("first")))
    gone = later.select(*spot).union(found.where("again").select(*spot))
    starts = gone.groupBy(*spot[:4]).agg(F.array_sort(F.collect_set("pos")).alias("starts"))
    rows = docs.select(F.struct("*").alias("row"), *key)
    joined = rows.join(starts, spot[:4], "left").select(
        "row", F.when(F.col("starts").isNotNull(), _without(F.col("row.text"), F.col("starts"), size)).alias("left")
    )
    text_left = F.when(F.col("left").isNotNull(), F.col("left.text")).otherwise(F.col("row.text"))
    columns = [(text_left if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns if c != count]
    return joined.select(*columns, F.coalesce("left.removed", F.lit(0)).alias(count))
