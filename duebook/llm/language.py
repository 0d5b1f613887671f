"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and everything but letters becomes a space.  An n-gram of one
to ``ORDER`` characters counts if it holds a letter and no two spaces follow each
other in it, so runs of other characters act as one boundary and n-grams never reach
from one text into the next.  It is hashed into one of ``BUCKETS`` buckets.

Training counts buckets for each language in numpy, one vector a language and task,
and sums the vectors by shuffle.  The matrix of log probabilities has one row a
language and ``BUCKETS`` columns whatever the size of the corpus; it is broadcast.
Scoring gathers its columns for the n-grams of a batch and sums them for each text.
Both work in slices of ``_SLICE`` characters, so memory does not grow with a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = 3
BUCKETS = 1 << 16
ALPHA = 0.1  # added to every count
FOLDS = 4
HELD_OUT = 2
UNKNOWN = "und"
_SLICE = 1 << 19  # code points
_GATHER = 1 << 22  # log probabilities


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _slices(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points, number of the text of each) with two spaces around each text.

    A slice repeats the last ``ORDER - 1`` code points of the one before, which count
    as starts of n-grams only here, so all n-grams come once.
    """
    points, numbers, size = [], [], 0
    tail = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def joined():
        return np.concatenate([tail[0], *points]), np.concatenate([tail[1], *numbers])

    for number, text in enumerate(texts):
        text = f" {text.lower()} "
        for at in range(0, len(text), _SLICE):
            part = np.frombuffer(text[at : at + _SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
            points.append(np.where(_letters()[part], part, np.uint32(32)))
            numbers.append(np.full(len(part), number, np.int64))
            size += len(part)
            if size >= _SLICE:
                whole = joined()
                yield whole
                tail = tuple(x[1 - ORDER :] for x in whole)
                points, numbers, size = [], [], 0
    if size:
        yield joined()[0], joined()[1]


def _grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, number of the text) of all n-grams, in order of the texts in each pair."""
    repeated = 0
    for points, numbers in _slices(texts):
        blank = points == 32
        apart = ~(blank[:-1] & blank[1:])
        code = points.astype(np.uint64)
        hashed, good = code * np.uint64(0x9E3779B97F4A7C15), ~blank
        for order in range(1, min(ORDER, len(points)) + 1):
            if order > 1:
                n = len(points) - order + 1
                hashed = (hashed[:n] ^ (code[order - 1 :] + np.uint64(order))) * np.uint64(0xD6E8FEB86659FD93)
                hashed ^= hashed >> np.uint64(32)
                good = apart if order == 2 else good[:n] & apart[order - 2 :]
            # n-grams inside the repeated code points came with the slice before
            skip = max(0, repeated - order + 1)
            at = skip + np.flatnonzero(good[skip:])
            yield (hashed[at] >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1), numbers[at]
        repeated = ORDER - 1


def bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and bucket counts of each language, once for a partition."""
    counts: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        langs, texts = batch["lang"].to_pylist(), batch["text"].to_pylist()
        for lang in dict.fromkeys(langs):
            mine = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            docs[lang] = docs.get(lang, 0) + len(mine)
            total = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for bucket, _ in _grams([t for t in mine if t]):
                total += np.bincount(bucket, minlength=BUCKETS)
    for lang, total in counts.items():
        at = np.flatnonzero(total)
        bucket, n = np.append(at, -1), np.append(total[at], docs[lang])  # bucket -1: documents
        names = pa.array([lang] * len(bucket), pa.string())
        yield pa.RecordBatch.from_arrays([names, pa.array(bucket), pa.array(n)], ["lang", "bucket", "n"])


class LanguageModel:
    """Log probabilities: ``matrix[bucket, language]`` and the languages' shares."""

    def __init__(self, spark: SparkSession, languages: list[str], matrix: np.ndarray, prior: np.ndarray):
        self.languages, self.matrix, self.prior = languages, matrix, prior
        self._sent = spark.sparkContext.broadcast((languages, matrix, prior))

    def predict(self, text: Column) -> Column:
        """struct(lang, score): the likeliest language and its posterior probability.

        ``und`` and 0 for a text that is null or has no letter, and for all texts if
        nothing was learned.
        """
        sent = self._sent

        def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in texts:
                langs, scores = predicted(batch.to_pylist(), *sent.value)
                yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], ["lang", "score"])

        return F.arrow_udf(batches, "struct<lang: string, score: double>")(text.cast("string"))


def predicted(texts: list[str | None], languages, matrix, prior) -> tuple[list[str], np.ndarray]:
    total = np.zeros((len(texts), len(languages)))
    grams = np.zeros(len(texts), np.int64)
    if languages:
        each = max(1, _GATHER // len(languages))
        for buckets, numbers in _grams([t or "" for t in texts]):
            grams += np.bincount(numbers, minlength=len(texts))
            for at in range(0, len(buckets), each):
                bucket, number = buckets[at : at + each], numbers[at : at + each]
                starts = np.flatnonzero(np.diff(number, prepend=-1))
                total[number[starts]] += np.add.reduceat(matrix[bucket], starts, axis=0)
    total += prior
    best = total.argmax(axis=1) if languages else np.zeros(len(texts), np.int64)
    score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1) if languages else np.zeros(len(texts))
    langs = [languages[k] if n else UNKNOWN for k, n in zip(best.tolist(), grams.tolist(), strict=True)]
    return langs, np.where(grams > 0, score, 0.0)


def log_probabilities(rows: list[tuple[str, int, int]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, matrix and prior from (language, bucket, count); bucket -1 holds documents."""
    languages = sorted({r[0] for r in rows})
    place = {lang: k for k, lang in enumerate(languages)}
    counts, docs = np.full((BUCKETS, len(languages)), ALPHA), np.zeros(len(languages))
    for lang, bucket, n in rows:
        if bucket < 0:
            docs[place[lang]] += n
        else:
            counts[bucket, place[lang]] += n
    matrix = np.log(counts / counts.sum(axis=0)) if languages else counts
    return languages, matrix, np.log(docs / docs.sum()) if languages else docs


def fit_language(docs: DataFrame) -> LanguageModel:
    """The model of all rows of ``docs`` with a language, outside fold ``HELD_OUT``.

    Rows whose language or id is null teach nothing; null and empty texts count as
    documents of their language only.  Repeated rows count as often as they come.  The
    driver gets one row for each language and bucket, the size of the matrix.
    """
    known = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    rows = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(bucket_counts, "lang string, bucket long, n long")
    summed = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    columns = [summed[c].to_pylist() for c in ("lang", "bucket", "n")]
    return LanguageModel(docs.sparkSession, *log_probabilities(list(zip(*columns, strict=True))))


def identify_language(docs: DataFrame, model: LanguageModel | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; by default learned from ``docs``.

    Any row is scored by its text alone: equal texts get equal results, whatever their
    other columns.  Columns of these two names in ``docs`` are replaced.
    """
    model = model or fit_language(docs)
    found = docs.select(F.struct("*").alias("row"), model.predict(F.col(text)).alias("found"))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("lang_pred", "score")]
    return found.select(*kept, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
