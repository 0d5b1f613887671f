"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models spell out the words of toxic and of ordinary
labelled texts: each predicts a word's letters from up to ``ORDER - 1`` letters
before.  The top order counts documents, lower orders count distinct letters
before (continuation counts).  The two lowest orders are shared by both classes,
and the larger class's counts are scaled to the smaller's, so that an expression
too rare to tell the classes apart gets about the same likelihood from both.

A toxic text is an ordinary one in which a share ``MIXED`` of the words was drawn
from the toxic model.  Its log-likelihood and that of an ordinary text differ by the
sum over words of ``log(1 - MIXED + MIXED * p_toxic / p_ordinary)``, where a ratio
under ``exp(NOISE)`` is none; divided by the number of words, it goes through a logistic
curve that is fitted on labelled rows left out of the counts.  Ordinary words so count
against a text, each by the same small amount.

Nothing is cut off, and what is counted stays in tables: the n-grams of each order, and
the corpus's distinct words, each of which is spelled once.  Words in chunks ask for
their distinct n-grams, the answers come back by chunk.  Texts then meet the words that
speak for toxicity: a broadcast where their table is small, which is measured, else a
shuffle by word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.plans.lookups import BROADCAST_BYTES, fits_in_broadcast

from .common import Scratch

ORDER = 6
SHARED_ORDERS = 2
DISCOUNT = 0.75
MIXED = 0.05
NOISE = 3.0
LETTER = 1 / 200  # below the first order
FOLDS = 4
HELD_OUT = 2
REJECT = 0.3
BINS = 1000  # steps of the curve's argument
_FLUSH = 1 << 19  # words
_CHUNK = 1 << 20  # letters
_TOKEN = re.compile(r"[^\W_]+")


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def grams_of(word: str) -> list[str]:
    """The longest n-gram that ends at each letter of a word, ``^`` before and ``$`` after it."""
    s = f"^{word}$"
    return [s[max(0, end - ORDER) : end] for end in range(2, len(s) + 1)]


# --- counts -------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a word, for each part of a partition."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def flushed() -> pa.RecordBatch:
        names = list({**counts[0], **counts[1]})
        rows = [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in counts)]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(rows, ["word", "c0", "c1"])

    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            counts[toxic].update(set(tokens(text)))
            if len(counts[0]) + len(counts[1]) > _FLUSH:
                yield flushed()
    yield flushed()


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each part of a partition."""
    seen: set[str] = set()
    for batch in batches:
        for text in batch["text"].to_pylist():
            seen.update(tokens(text))
            if len(seen) > _FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])
                seen.clear()
    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])


def _summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("c0", "c1")))


def _top_grams(words: DataFrame) -> DataFrame:
    """:func:`grams_of` all words, with the counts of the words."""
    spelled = words.select(F.concat(F.lit("^"), "word", F.lit("$")).alias("s"), "c0", "c1")
    ends = F.sequence(F.lit(2), F.length("s"))
    grams = F.transform(ends, lambda e: F.substring(F.col("s"), F.greatest(e - ORDER + 1, F.lit(1)), F.least(e, F.lit(ORDER))))
    return _summed(spelled.select(F.explode(grams).alias("gram"), "c0", "c1"), "gram")


@dataclass
class Order:
    """``grams``: what a gram has of its own (``a0``, ``a1``, ordinary and toxic);
    ``contexts``: what a context leaves to the next lower order (``w0``, ``w1``)."""

    grams: DataFrame
    contexts: DataFrame


def fit_orders(words: DataFrame, scratch: Scratch) -> list[Order]:
    """Both models, lowest order first, from the words' document counts ``c0``, ``c1``.

    The discount is taken whole from a count of one or more, and in proportion from
    what scaling left of it.
    """
    top = scratch.cut(_top_grams(words))
    orders: list[Order] = []
    grams = top.where(F.length("gram") == ORDER)
    for order in range(ORDER, 0, -1):
        if order < ORDER:
            longer = grams.select(F.substring("gram", 2, order).alias("gram"), *((F.col(c) > 0).cast("long").alias(c) for c in ("c0", "c1")))
            starts = top.where((F.length("gram") == order) & F.col("gram").startswith("^"))
            grams = scratch.cut(_summed(longer.union(starts), "gram"))
        sums = [float(x or 0) for x in grams.agg(F.sum("c0"), F.sum("c1")).first()]
        least = min([x for x in sums if x], default=0.0)
        each = [F.col(c) * F.lit(least / x if x else 0.0) for c, x in zip(("c0", "c1"), sums, strict=True)]
        if order <= SHARED_ORDERS:
            each = [each[0] + each[1]] * 2
        context = F.substring("gram", 1, order - 1).alias("context")
        sized = grams.select("gram", context, *(x.alias(f"k{i}") for i, x in enumerate(each)))
        left = [F.sum(F.col(k) - F.lit(DISCOUNT) * F.least(F.col(k), F.lit(1.0))) for k in ("k0", "k1")]
        totals = sized.groupBy("context").agg(*(F.sum(f"k{i}").alias(f"t{i}") for i in (0, 1)), *(x.alias(f"o{i}") for i, x in enumerate(left)))
        contexts = scratch.cut(totals)
        weights = (F.when(F.col(f"t{i}") > 0, 1 - F.col(f"o{i}") / F.col(f"t{i}")).otherwise(1.0).alias(f"w{i}") for i in (0, 1))
        own = (
            F.when(F.col(f"t{i}") > 0, (F.col(f"k{i}") - F.lit(DISCOUNT) * F.least(F.col(f"k{i}"), F.lit(1.0))) / F.col(f"t{i}")).otherwise(0.0).alias(f"a{i}")
            for i in (0, 1)
        )
        found = scratch.cut(sized.join(contexts, "context").select("gram", *own))
        orders.insert(0, Order(found, contexts.select("context", *weights)))
    return orders


def gram_ratios(asked: DataFrame, orders: list[Order], scratch: Scratch) -> DataFrame:
    """``gram`` and ``ratio``, the log-likelihood ratio of its last letter given the others,
    for the distinct grams of ``asked``: from the lowest order up, a context that was seen
    adds its own, one that was not leaves all to the order below."""
    below, parts = None, []
    for n, order in enumerate(orders, 1):
        ends = asked.where(F.length("gram") >= n).select(F.substring(F.col("gram"), F.length("gram") - n + 1, F.lit(n)).alias("gram")).distinct()
        known = ends.withColumns({"context": F.substring("gram", 1, n - 1), "shorter": F.substring("gram", 2, n)})
        known = known.join(order.contexts, "context", "left").join(order.grams, "gram", "left")
        if below is None:
            known = known.withColumns({"l0": F.lit(LETTER), "l1": F.lit(LETTER)})
        else:
            known = known.join(below.select(F.col("gram").alias("shorter"), F.col("p0").alias("l0"), F.col("p1").alias("l1")), "shorter")
        value = (
            F.when(F.col(f"w{i}").isNull(), F.col(f"l{i}")).otherwise(F.coalesce(f"a{i}", F.lit(0.0)) + F.col(f"w{i}") * F.col(f"l{i}")).alias(f"p{i}")
            for i in (0, 1)
        )
        below = scratch.cut(known.select("gram", *value))
        parts.append(below if n == len(orders) else below.where(F.col("gram").startswith("^")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole.select("gram", F.ln(F.col("p1") / F.col("p0")).alias("ratio"))


# --- words --------------------------------------------------------------------


def _asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of words and the distinct grams of each chunk."""
    from pyspark import TaskContext

    chunk, words, size = TaskContext.get().partitionId() << 32, [], 0

    def asked() -> pa.RecordBatch:
        grams = list({g for w in words for g in grams_of(w)})
        columns = [pa.array([chunk] * (len(words) + len(grams))), pa.array(words + [None] * len(grams), pa.string()), pa.array([None] * len(words) + grams, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "word", "gram"])

    for batch in batches:
        for word in batch["word"].to_pylist():
            if words and size + len(word) > _CHUNK:
                yield asked()
                chunk, words, size = chunk + 1, [], 0
            words.append(word)
            size += len(word)
    if words:
        yield asked()


def _spelled(words: pa.Table, answers: pa.Table) -> pa.Table:
    ratio = dict(zip(answers["gram"].to_pylist(), answers["ratio"].to_pylist(), strict=True))
    names = words["word"].to_pylist()
    return pa.table([words["word"], pa.array([math.fsum(map(ratio.__getitem__, grams_of(w))) for w in names], pa.float64())], ["word", "ratio"])


def word_ratios(words: DataFrame, orders: list[Order], scratch: Scratch) -> DataFrame:
    """``word`` and ``ratio``, its log-likelihood ratio, for distinct words."""
    rows = scratch.cut(words.mapInArrow(_asking, "chunk long, word string, gram string"))
    asks = rows.where(F.col("gram").isNotNull()).select(F.col("chunk").alias("asker"), "gram")
    answers = asks.join(gram_ratios(asks.select("gram").distinct(), orders, scratch), "gram")
    mine = rows.where(F.col("word").isNotNull()).select("chunk", "word")
    return mine.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(_spelled, "word string, ratio double")


def gain(ratio: Column) -> Column:
    """What a word of this ratio adds to the comparison, less what an ordinary one does."""
    toxic = F.log1p(F.lit(MIXED) * (F.exp(F.least(ratio, F.lit(500.0))) - 1))
    return F.when(ratio > NOISE, toxic - math.log1p(-MIXED)).otherwise(0.0)


# --- texts --------------------------------------------------------------------


def mean_gain(text: str | None, gains: dict[str, float]) -> float:
    """The sum of the words' gains by the number of words; 0 for a text without words."""
    words = tokens(text)
    return math.fsum(map(gains.__getitem__, filter(gains.__contains__, words))) / len(words) if words else 0.0


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The share of each distinct word in its text, a text at a time."""
    for batch in batches:
        for place, text in zip(batch["place"].to_pylist(), batch["text"].to_pylist(), strict=True):
            words = Counter(tokens(text))
            if words:
                total = words.total()
                columns = [pa.array([place] * len(words)), pa.array(list(words)), pa.array([n / total for n in words.values()])]
                yield pa.RecordBatch.from_arrays(columns, ["place", "word", "share"])


def with_mean_gain(docs: DataFrame, telling: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``gain``, the mean over its words.

    ``telling`` (``word``, ``gain``) is broadcast if it takes at most ``max_bytes``, else
    joined with the distinct words of the texts by shuffle; the results are the same.
    """
    spark = docs.sparkSession
    if fits_in_broadcast(telling, max_bytes):
        sent = spark.sparkContext.broadcast({r.word: r.gain for r in telling.collect()})

        def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            gains = sent.value
            for batch in texts:
                yield pa.array([mean_gain(x.as_py(), gains) for x in batch], pa.float64())

        return docs.select(F.struct("*").alias("row"), F.arrow_udf(batches, "double")(F.col("text").cast("string")).alias("gain"))
    placed = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place"))
    placed = Scratch(spark).cut(placed)  # from here on a row has one place
    texts = placed.select("place", F.col("row.text").cast("string").alias("text"))
    shares = texts.mapInArrow(_shares, "place long, word string, share double")
    sums = shares.join(telling, "word").groupBy("place").agg(F.sum(F.col("share") * F.col("gain")).alias("gain"))
    return placed.join(sums, "place", "left").select("row", F.coalesce("gain", F.lit(0.0)).alias("gain"))


def _curve(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Logistic regression of the class, from (argument, class, count); weak
    priors hold the slope near 3 and the offset near -3 where rows are few."""
    x, y, n = (np.array(v, dtype=np.float64) for v in zip(*rows, strict=True)) if rows else (np.zeros(0),) * 3
    a, b = 3.0, -3.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        v = n * p * (1 - p)
        slope = np.array([(n * (y - p) * x).sum() - (a - 3) * 0.5, (n * (y - p)).sum() - (b + 3) * 0.5])
        bend = np.array([[(v * x * x).sum() + 0.5, (v * x).sum()], [(v * x).sum(), v.sum() + 0.5]])
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 2 / (np.abs(step).max() + 1e-12))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 0.0), float(b)

@dataclass
class ToxicityModel:
    """Fitted tables and curve, and the words of the fitted documents that tell."""

    orders: list[Order]
    telling: DataFrame
    slope: float = 3.0
    offset: float = -3.0

    def scored(self, docs: DataFrame, telling: DataFrame | None = None) -> DataFrame:
        """``row`` (all columns of ``docs``) and ``score``: 0 to 1, higher for likelier
        toxic, defined for empty and null texts too.

        Words that the fitted documents do not hold need ``telling`` of their own, from
        :func:`telling_words`.
        """
        found = with_mean_gain(docs, self.telling if telling is None else telling)
        return found.select("row", (1 / (1 + F.exp(-(argument(F.col("gain")) * self.slope + self.offset)))).alias("score"))


def argument(mean: Column) -> Column:
    return F.log1p(100 * mean)


def telling_words(docs: DataFrame, orders: list[Order], scratch: Scratch) -> DataFrame:
    """``word`` and ``gain`` of the words of ``docs`` that speak for toxicity."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    words = texts.mapInArrow(_distinct_words, "word string").distinct()
    found = word_ratios(words, orders, scratch).select("word", gain(F.col("ratio")).alias("gain"))
    return found.where("gain > 0")


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """The model of the documents' texts and ``labels.toxic``.

    Rows whose fold is ``HELD_OUT`` are never read with a label.  A document
    labelled more than once is toxic if any label says so; null labels and ids
    do not count.  A quarter of the other rows fits the curve.  Without any
    labelled row all texts get the same low score.
    """
    scratch, kept = Scratch(docs.sparkSession), Scratch(docs.sparkSession)
    marked = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    mine = docs.where(fold(F.col("doc_id")) != HELD_OUT).select("doc_id", F.col("text").cast("string").alias("text"))
    for_curve = F.floor(F.crc32(F.col("doc_id").cast("string")) / FOLDS) % 4 == 0
    # By shuffle at every size: the labels grow with the documents.
    rows = scratch.cut(mine.join(marked.hint("merge"), "doc_id").select("text", "toxic", for_curve.alias("for_curve")))
    counted = rows.where("not for_curve").select("text", "toxic")
    words = scratch.cut(_summed(counted.mapInArrow(_word_counts, "word string, c0 long, c1 long"), "word"))
    orders = fit_orders(words, kept)
    telling = kept.cut(telling_words(docs, orders, scratch))
    found = with_mean_gain(rows.where("for_curve"), telling)
    bins = F.round(argument(F.col("gain")) * BINS).cast("long")
    held = found.select(bins.alias("bin"), F.col("row.toxic").alias("toxic")).groupBy("bin", "toxic").agg(F.count("*").alias("n"))
    slope, offset = _curve([(b / BINS, y, n) for b, y, n in sorted(held.collect())])  # the bins are bounded
    scratch.clear()
    return ToxicityModel(orders, telling, slope, offset)


def toxicity_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored under ``REJECT``, with all columns of ``docs``.

    Empty and null texts and repeated rows are scored like any other.
    """
    return fit_toxicity(docs, labels).scored(docs).where(F.col("score") < REJECT).select("row.*")
