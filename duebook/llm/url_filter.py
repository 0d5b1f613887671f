"""URL filter: explicit rules, then the reputation of the host.

Labelled outcomes of pages are counted by host.  A host's share of good pages has
a beta prior whose mean is the posterior mean of its registered domain, whose
prior comes from its suffix, whose prior comes from all pages together.  Each
level's prior strength is estimated from how much its members differ beyond
binomial noise (empirical Bayes, method of moments).  A host passes if the lower
bound of its posterior reaches a threshold; a host without labelled pages has the
expectation and spread of its domain, suffix or all pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LEAST_GOOD = 0.5
DEVIATIONS = 1.28
# Bounds of the correlation within a group, so of prior strengths from 1/9 to 999.
LEAST_RHO, MOST_RHO = 0.001, 0.9

# Fixed values: (verdict, host, path); a rule holds for the host and its subdomains.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with
    A-Z lower-cased, and then up to ``?``, ``#`` or the end; else both empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null if none does.

    ``rules`` is a short list: it becomes one expression, without any join.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        name, verdict = F.when(fits, of + start).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


# Labels under which country codes register domains, and hosts whose
# subdomains belong to different people.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "go", "ne", "net", "nom", "or", "org")
SHARED_HOSTS = ("github.io", "gitlab.io", "blogspot.com", "wordpress.com", "netlify.app", "pages.dev", "herokuapp.com")
_SUFFIX = "(?:(?:" + "|".join(SECOND_LEVEL) + r")[.][a-z]{2}|" + "|".join(h.replace(".", "[.]") for h in SHARED_HOSTS) + r"|[^.:]+)"
SUFFIX_PATTERN = r"(?:^|[.])(" + _SUFFIX + r")(?::[0-9]*)?$"
DOMAIN_PATTERN = r"(?:^|[.])((?:[^.:]+[.])?" + _SUFFIX + r")(?::[0-9]*)?$"


def domain_of(host: Column) -> Column:
    """The suffix and the label before it, without a port; empty for what has none."""
    return F.regexp_extract(host, DOMAIN_PATTERN, 1)


def suffix_of(host: Column) -> Column:
    """What domains are registered under: a country code with a label of
    ``SECOND_LEVEL``, a shared host, else the last label."""
    return F.regexp_extract(host, SUFFIX_PATTERN, 1)


def _shrunk(groups: DataFrame, mean: Column) -> DataFrame:
    """``groups`` (columns good, n) with ``mean`` (the posterior's) and ``strength``
    (prior and counts together), from the parents' means ``mean``."""
    spread = F.col("mu") * (1 - F.col("mu"))
    known = groups.withColumn("mu", mean)
    noise = F.when(F.col("n") > 0, F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("mu"), 2) - spread)
    over, weight = known.agg(F.sum(noise), F.sum(F.when(F.col("n") > 0, spread * (F.col("n") - 1)))).first()
    rho = min(MOST_RHO, max(LEAST_RHO, (over or 0.0) / weight if weight else LEAST_RHO))
    prior = 1 / rho - 1
    return known.withColumn("strength", prior + F.col("n")).withColumn("mean", (prior * F.col("mu") + F.col("good")) / (prior + F.col("n"))).drop("mu")


def reputations(outcomes: DataFrame) -> DataFrame:
    """``host``, ``bound`` of every host of ``outcomes`` (columns host and good: 1,
    0, or null for a page without a label)."""
    scratch = Scratch(outcomes.sparkSession)
    counts = (F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("n"))
    hosts = scratch.cut(outcomes.groupBy("host").agg(*counts))
    hosts = hosts.select("*", domain_of(F.col("host")).alias("domain"))
    sums = (F.sum("good").alias("good"), F.sum("n").alias("n"))
    domains = scratch.cut(hosts.groupBy("domain").agg(*sums)).withColumn("suffix", suffix_of(F.col("domain")))
    suffixes = scratch.cut(domains.groupBy("suffix").agg(*sums))
    good, n = suffixes.agg(*sums).first()
    overall = F.lit(((good or 0) + 1) / ((n or 0) + 2))
    by_suffix = scratch.cut(_shrunk(suffixes, overall).select("suffix", F.col("mean").alias("above")))
    by_domain = scratch.cut(_shrunk(domains.join(by_suffix, "suffix"), F.col("above")).select("domain", F.col("mean").alias("above")))
    found = _shrunk(scratch.cut(hosts.join(by_domain, "domain")), F.col("above"))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("strength") + 1))
    return scratch.cut(found.select("host", (F.col("mean") - DEVIATIONS * spread).alias("bound")))


def url_filter(pages: DataFrame, outcomes: DataFrame, least: float = LEAST_GOOD) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) of every page.

    ``outcomes`` has ``url`` and ``good`` (1, 0 or null).  A null url or one without
    ``://`` has an empty host and path and is judged as the host ``''``; a host
    without outcomes is judged like one of its domain.  Rows come out as often as
    they came in; null ids stay null; an empty table gives an empty table.
    """
    host, path = host_and_path(F.col("url"))
    rule, says = rule_of(F.col("host"), F.col("path"))
    seen = outcomes.select(host.alias("host"), F.col("good").cast("int").alias("good"))
    every = seen.union(pages.select(host, F.lit(None).cast("int")))
    known = reputations(every)
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).select("*", rule.alias("rule"), says.alias("says"))
    verdict = F.coalesce("says", F.when(F.col("bound") >= least, "allow").otherwise("block"))
    return judged.join(known, "host").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
