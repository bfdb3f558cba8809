"""URL filter: listed rules first, else the reputation of the host; DataFrame functions only.

The reputation is an empirical-Bayes estimate of the share of good pages. The outcomes of a level are shrunk towards
its parent (host to registered domain, domain to suffix, suffix to all pages) with a beta prior whose mean is the
parent's posterior mean and whose strength is fitted to how much the level's members differ, by moments.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, fresh
from tidemark.session import freeze

#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Second-level labels under which countries register domains.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
STRENGTH = (1.0, 10_000.0)
Z = 1.645
THRESHOLD = 0.5


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null and for a url without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels, or three where the second is one like co in co.uk."""
    pattern = rf"([^.]+\.(?:(?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}|[^.]+))$"
    found = F.regexp_extract(host, pattern, 1)
    return F.when(found == "", host).otherwise(found)


def suffix_of(domain: Column) -> Column:
    return F.regexp_replace(domain, r"^[^.]*\.", "")


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """A struct of the longest rule that fits and its verdict, or null. rules is a short list that someone keeps."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    cases = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        cases = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(cases)
    return cases


def _strength(level: DataFrame) -> DataFrame:
    """One row: the prior's weight in pages, from n, good and the parent's mean mu.

    For members that differ with correlation rho, the sum of n (good/n - mu)^2 / (mu (1 - mu)) is expected to be the
    sum of 1 + (n - 1) rho. Solved for rho, the weight is 1 / rho - 1, held within STRENGTH.
    """
    seen = level.where("n > 0")
    spread = F.sum((F.col("good") - F.col("n") * F.col("mu")) ** 2 / (F.col("n") * F.col("mu") * (1 - F.col("mu"))))
    rho = (spread - F.count(F.lit(1))) / F.nullif(F.sum("n") - F.count(F.lit(1)), F.lit(0))
    low, high = STRENGTH
    weight = F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(high))
    return seen.agg(F.least(F.greatest(F.coalesce(weight, F.lit(high)), F.lit(low)), F.lit(high)).alias("weight"))


def reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """host, n, good, mean and bound for every host in outcomes (host, good: true, false or null for not labelled).

    bound is the posterior mean less z posterior standard deviations. Hosts without labels have their domain's prior.
    The mean over all labelled pages starts from one half with the weight of one page. An empty table gives no hosts.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("good").alias("n"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good")
    )
    hosts = freeze(hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain"))))
    total = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = hosts.groupBy("suffix", "domain").agg(*total)
    suffixes = domains.groupBy("suffix").agg(*total)
    start = suffixes.agg(*total).select(((F.coalesce("good", F.lit(0)) + 0.5) / (F.coalesce("n", F.lit(0)) + 1)).alias("mu"))

    def shrunk(level: DataFrame) -> DataFrame:
        return level.crossJoin(F.broadcast(_strength(level))).withColumn(
            "mean", (F.col("good") + F.col("weight") * F.col("mu")) / (F.col("n") + F.col("weight"))
        )

    suffixes = shrunk(suffixes.crossJoin(F.broadcast(start)))
    domains = shrunk(domains.join(suffixes.select("suffix", F.col("mean").alias("mu")), "suffix"))
    hosts = shrunk(hosts.join(domains.select("domain", F.col("mean").alias("mu")), "domain"))
    variance = F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("weight") + 1)
    return hosts.select("host", "n", "good", "mean", (F.col("mean") - z * F.sqrt(variance)).alias("bound"))


def outcomes_of(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and good: no row of the key calls it of low quality (0) or toxic (1). Null ratings say nothing."""
    seen = labels.where(F.col(key).isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    good = (F.coalesce(F.min("quality"), F.lit(1)) == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)
    return seen.groupBy(F.col(key).alias("key")).agg(good.alias("good"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          threshold: float = THRESHOLD, z: float = Z, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """The columns of pages, and host, path, rule, verdict, n_labelled, n_good and bound.

    A rule that fits decides; else a page is allowed where its host's posterior bound reaches the threshold. Pages are
    labelled through labels.doc_id = page_id. A null url has an empty host, which is judged like any other. Repeated
    pages count each. Input columns with one of the new names are replaced.
    """
    new = ("host", "path", "rule", "verdict", "n_labelled", "n_good", "bound")
    rows = pages.drop(*new)
    rows = rows.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    seen = rows.select(F.col(page_id).alias("key"), "host").join(outcomes_of(labels), "key", "left")
    known = freeze(reputation(seen.select("host", "good"), z).select(
        F.col("host").alias("h"), F.col("n").alias("n_labelled"), F.col("good").alias("n_good"), "bound"
    ))
    site, hit = fresh(rows, "_site"), fresh(rows, "_hit")
    out = rows.join(known.withColumnRenamed("h", site), F.col("host") == F.col(site), "left").withColumn(
        hit, rule_for(F.col("host"), F.col("path"), rules)
    )
    own = F.when(F.col("bound") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return out.withColumns({
        "rule": F.col(f"{hit}.rule"), "verdict": F.coalesce(F.col(f"{hit}.verdict"), own)
    }).drop(site, hit).select(*rows.columns, *new[2:])
