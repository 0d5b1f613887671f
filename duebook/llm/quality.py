"""Document quality by weak supervision.

Rules vote good (1), bad (-1) or abstain (0) on each document.  How often each
rule votes rightly is not known beforehand: expectation-maximisation estimates,
from the counts of all vote patterns of the corpus, the share of good documents
and how often each rule's
votes are right on good and on bad documents
(Dawid and Skene, 1979).  A document's posterior probability of being good then
weighs all votes; no single rule has to pass.

A pattern has one of three values for each rule, so the counts are at most
``3 ** len(RULES)`` rows whatever the size of the corpus.  They are fitted on the
driver in plain Python; features, votes and posteriors are column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT = 5
KEEP = 0.5
GOOD = 0.9
ON_BAD = 0.5
ON_GOOD = 0.99
PRIOR = 0.1
ROUNDS = 200


def features(text: Column) -> Column:
    """A struct of counts of a text; a null text counts as an empty one.

    Words are runs of characters other than the six ASCII white spaces.
    ``n_repeat_words`` compares five-word windows by 64-bit hashes within the text.
    """
    whole = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
            let(F.transform(w, lambda x: F.xxhash64(x)), _repeated).cast("long").alias("n_repeat_words"),
        )

    def of_lines(x: Column) -> Column:
        ended = F.filter(x, lambda line: line.rlike(r"[.!?:;\"'”»)]\s*$"))
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(ended).cast("long").alias("n_ended_lines"),
        )

    counted = F.struct(
        let(words(whole), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(whole, F.lit("[!?]")).cast("long").alias("n_shouts"),
        F.regexp_count(whole, F.lit(r"[^\p{L}\p{N}\s]")).cast("long").alias("n_marks"),
    )

    def flat(x: Column) -> Column:
        names = {
            "w": ("n_words", "word_chars", "n_distinct_words", "n_repeat_words"),
            "l": ("n_lines", "n_dup_lines", "n_ended_lines"),
        }
        parts = [x[k][name].alias(name) for k, found in names.items() for name in found]
        return F.struct(*parts, *(x[name].alias(name) for name in ("n_symbols", "n_upper", "n_shouts", "n_marks")))

    return let(counted, flat)


def _repeated(hashes: Column) -> Column:
    """Words in windows that occur twice or more: positions of repeated windows
    are sorted, and each adds the words up to the next one, five at most."""

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - REPEAT)
        found = F.transform(at, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(REPEAT))))
        return F.when(F.size(h) >= REPEAT, found).otherwise(F.array().cast("array<bigint>"))

    def covered(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            def same(x: Column, k: Column) -> Column:
                return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))

            return F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])

        def total(p: Column) -> Column:
            step = F.transform(p, lambda x, i: F.least(F.lit(REPEAT), F.coalesce(F.get(p, i + 1) - x, F.lit(REPEAT))))
            return F.aggregate(step, F.lit(0), lambda a, b: a + b)

        return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(let(F.sort_array(let(ordered, twice)), total))

    return let(let(hashes, windows), covered)


def base_failed(x: Column) -> Column:
    return (x["n_words"] < MIN_WORDS) | (100 * x["n_repeat_words"] > MAX_REPEAT_PERCENT * x["n_words"])


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(x: Column) -> dict[str, Column]:
    """The rules' votes on a struct of features.  Thresholds are shares of words,
    characters or lines; between good and bad a rule abstains."""

    def share(part: Column, whole: Column) -> Column:
        return part / F.greatest(whole, F.lit(1))

    n, lines = x["n_words"], x["n_lines"]
    symbols, shouts, marks = (share(x[c], n) for c in ("n_symbols", "n_shouts", "n_marks"))
    upper, mean = share(x["n_upper"], x["word_chars"]), share(x["word_chars"], n)
    dup, repeat = share(x["n_dup_lines"], lines), share(x["n_repeat_words"], n)
    distinct, ended = share(x["n_distinct_words"], n), share(x["n_ended_lines"], lines)
    return {
        "symbols": _vote(symbols > 0.1, symbols <= 0.02),
        "marks": _vote((n >= 20) & (marks > 0.4), marks <= 0.25),
        "capitals": _vote(upper > 0.3, upper <= 0.15),
        "shouts": _vote(shouts > 0.3, shouts <= 0.1),
        "word length": _vote((mean < 3) | (mean > 7.2), mean.between(4.3, 6.5)),
        "equal lines": _vote(dup > 0.3, (lines >= 3) & (dup <= 0.1)),
        "repeated windows": _vote(repeat > 0.3, (n >= 20) & (repeat <= 0.1)),
        "distinct words": _vote((n >= 20) & (distinct < 0.3), (n >= 20) & (distinct > 0.45)),
        "ended lines": _vote((lines >= 3) & (ended < 0.3), ended >= 0.7),
    }


RULES = ("symbols", "marks", "capitals", "shouts", "word length", "equal lines", "repeated windows", "distinct words", "ended lines")


@dataclass(frozen=True)
class QualityModel:
    """Share of good documents; for each rule how often its vote is right on bad
    and on good documents.  Abstaining says nothing about a document."""

    good: float
    rates: dict[str, tuple[float, float]]

    def weights(self, rule: str) -> tuple[float, float]:
        """What a bad and a good vote add to the log-odds of being good."""
        on_bad, on_good = self.rates[rule]
        return math.log((1 - on_good) / on_bad), math.log(on_good / (1 - on_bad))

    def posterior(self, x: Column) -> Column:
        """Probability that a document with these features is good."""
        logit = F.lit(math.log(self.good / (1 - self.good)))
        for name, vote in votes(x).items():
            bad, good = self.weights(name)
            logit = logit + F.when(vote < 0, bad).when(vote > 0, good).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def fit(counts: list[tuple[dict[str, int], int]]) -> QualityModel:
    """Expectation-maximisation over (votes of a pattern, documents with it).

    The start says that rules are mostly right: few good documents get a bad
    vote, and half of the votes on bad ones are bad, for a document is mostly bad
    in one way.  The start weighs as much as ``PRIOR`` of the documents, whatever
    their number, so that a rule no other rule agrees with keeps its meaning; an
    empty corpus gives the start itself.
    """
    total = sum(n for _, n in counts)
    good, rates = GOOD, {name: (ON_BAD, ON_GOOD) for name in RULES}
    prior = PRIOR * total
    for _ in range(ROUNDS if total else 0):
        right = {r: [prior * (1 - GOOD) * ON_BAD, prior * GOOD * ON_GOOD] for r in RULES}
        voted = {r: [prior * (1 - GOOD), prior * GOOD] for r in RULES}
        mass, model = prior * GOOD, QualityModel(good, rates)
        weights = {r: model.weights(r) for r in RULES}
        for pattern, n in counts:
            logit = math.log(good / (1 - good)) + sum(weights[r][v > 0] for r, v in pattern.items() if v)
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))
            mass += p * n
            for r, v in pattern.items():
                if v:
                    voted[r][0] += (1 - p) * n
                    voted[r][1] += p * n
                    right[r][v > 0] += (p if v > 0 else 1 - p) * n
        before, good = good, mass / (total + prior)
        rates = {r: (right[r][0] / voted[r][0], min(right[r][1] / voted[r][1], 1 - 1e-6)) for r in RULES}
        if abs(good - before) < 1e-9:
            break
    return QualityModel(good, rates)


def fit_quality(counted: DataFrame, column: str = "features") -> QualityModel:
    """The model of a table whose struct ``column`` holds :func:`features`."""
    found = votes(F.col(column))
    patterns = counted.groupBy(*(vote.alias(name) for name, vote in found.items())).agg(F.count("*").alias("documents"))
    rows = patterns.collect()  # at most 3 ** len(RULES)
    return fit([({name: r[name] for name in RULES}, r["documents"]) for r in sorted(rows)])


def kept(model: QualityModel, x: Column) -> Column:
    return ~base_failed(x) & (model.posterior(x) >= KEEP)


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all columns of ``docs``.

    Empty, null and very short texts fail the base rules; repeated rows are
    judged alike; an empty table gives an empty table.
    """
    rows = docs.select(F.struct("*").alias("row"), features(F.col("text")).alias("features"))
    rows = Scratch(docs.sparkSession).cut(rows)  # the features are counted once
    model = fit_quality(rows)
    return rows.where(kept(model, F.col("features"))).select("row.*")
