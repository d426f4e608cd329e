"""URL filters: rules by host and path, else an empirical-Bayes host reputation.

A url's host and path are cut out with built-in string functions.  Rules
``(host, path, verdict)`` fit their host and every subdomain of it when the
url's path starts with theirs; the longest rule (host and path together) wins.

Urls that no rule fits are judged by reputation.  Labelled page outcomes
(``bad`` 0 or 1) are counted per host, per registered domain and per suffix.
Each level is a beta-binomial whose prior mean is the posterior mean of the
level above (the suffix takes the mean of all outcomes) and whose prior
strength is estimated from the spread of the level's own groups by moments.
A host is blocked when the lower bound of its posterior bad rate, mean minus
``Z`` standard deviations, reaches ``BLOCK_AT``; a host without labels takes
the prior of its registered domain.  Everything is an aggregate or a join on
a key of one row per group, so hot hosts are combined before any shuffle.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.session import settle

# Fixed values of the contract: rules as (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
Z = 1.645  # one-sided 95 %
BLOCK_AT = 0.5  # a host whose bad rate is surely at least this is blocked
STRENGTH_RANGE = (1.0, 1000.0)  # prior strengths in pseudo-pages

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; path: then up to
    ``?``, ``#`` or end.  A null url or one without ``://`` has both empty."""
    at = F.instr(url, "://")
    after = F.when(at > 0, url.substr(at + 3, F.lit(2 ** 31 - 1)))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit("")),
            F.coalesce(path, F.lit("")))


def matched_rules(urls: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``_host, _path, rule, rule_verdict`` of the winning rule of each distinct ``_host, _path`` that one fits.

    The rules are a parameter of a few rows, broadcast by their own bound; a url
    meets each rule in a join on its host and the suffixes of its host.
    """
    spark = urls.sparkSession
    table = spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")
    labels = F.split(F.col("_host"), r"\.")
    # the host and each of its parent domains: at most as many as the host has dots, plus one
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    distinct = urls.select("_host", "_path").distinct()  # combined before the shuffle: hot urls are one row
    heads = distinct.select("_host", "_path", F.explode(suffixes).alias("rule_host"))
    fits = heads.join(F.broadcast(table), "rule_host").where(F.col("_path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    # longest first; of equally long ones block, then the smaller text
    best = F.min_by(F.struct(rule.alias("rule"), "rule_verdict"),
                    F.struct(-F.length(rule), F.when(F.col("rule_verdict") == "block", 0).otherwise(1), rule))
    return fits.groupBy("_host", "_path").agg(best.alias("_best")).select(
        "_host", "_path", "_best.rule", "_best.rule_verdict")


def _strength(groups: DataFrame) -> Column:
    """Prior strength of a level by moments, from groups ``n, k, prior_mean``: mean binomial variance over the
    excess of observed over binomial variance, less one; kept in ``STRENGTH_RANGE``."""
    rate = F.col("k") / F.col("n")
    binomial = F.col("prior_mean") * (1 - F.col("prior_mean"))
    excess = F.avg(F.pow(rate - F.col("prior_mean"), 2) - binomial / F.col("n"))
    low, high = STRENGTH_RANGE
    raw = F.avg(binomial) / excess - 1
    return F.when(excess > 0, F.least(F.greatest(raw, F.lit(low)), F.lit(high))).otherwise(F.lit(high))


def _level(groups: DataFrame, key: str) -> DataFrame:
    """Posterior ``a, b, mean`` of each group ``key, n, k, prior_mean``; the level's strength is one number."""
    labelled = groups.where("n > 0")
    strength = F.lit(labelled.agg(_strength(labelled)).first()[0])
    return groups.select(
        key, "n", "k", "prior_mean",
        (F.col("k") + strength * F.col("prior_mean")).alias("a"),
        (F.col("n") - F.col("k") + strength * (1 - F.col("prior_mean"))).alias("b"),
    ).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))


def reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``_host, mean, lower, hosted_pages, labelled, bad`` per host of ``pages`` (``_host``), from ``outcomes``
    (``_host, bad``), one row per labelled page."""
    counted = outcomes.where(F.col("bad").isin(0, 1)).groupBy("_host").agg(
        F.count("*").alias("n"), F.sum("bad").alias("k"))
    hosts = settle(pages.groupBy("_host").agg(F.count("*").alias("hosted_pages")).join(counted, "_host", "full_outer")
                   .select("_host", F.coalesce("hosted_pages", F.lit(0)).alias("hosted_pages"),
                           F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k"),
                           F.substring_index("_host", ".", -2).alias("_domain"),
                           F.substring_index("_host", ".", -1).alias("_suffix")))  # one row a host, read thrice
    domains = hosts.groupBy("_domain", "_suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("_suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).first()[0]
    by_suffix = _level(suffixes.withColumn("prior_mean", F.lit(float(total))), "_suffix")
    by_domain = _level(
        domains.join(by_suffix.select("_suffix", F.col("mean").alias("prior_mean")), "_suffix"), "_domain")
    by_host = _level(
        hosts.join(by_domain.select("_domain", F.col("mean").alias("prior_mean")), "_domain"), "_host")
    spread = F.sqrt(F.col("a") * F.col("b") / (F.pow(F.col("a") + F.col("b"), 2) * (F.col("a") + F.col("b") + 1)))
    return by_host.join(hosts.select("_host", "hosted_pages"), "_host").select(
        "_host", "mean", (F.col("mean") - F.lit(Z) * spread).alias("lower"), "hosted_pages",
        F.col("n").alias("labelled"), F.col("k").alias("bad"))


def judge(pages: DataFrame, outcomes: DataFrame, url: str = "url",
          rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Every row of ``pages`` with ``host, path, rule, verdict, bad_mean, bad_lower``.

    ``outcomes`` holds ``url, bad`` of labelled pages (bad 1: the page was bad);
    rows with another ``bad`` do not count.  ``rule`` is the winning rule as
    ``host/path`` text, null where none fits; ``verdict`` is its verdict, else
    ``block`` when ``bad_lower`` >= ``BLOCK_AT``, else ``allow``.  Null and empty
    urls have host and path ``''``: they form one host of their own.  Rows are
    never merged: repeated urls are judged alike, each in its row.  Columns of
    ``pages`` named like the result's are replaced.
    """
    new = ["host", "path", "rule", "verdict", "bad_mean", "bad_lower"]
    base = pages.drop(*[c for c in new if c in pages.columns])
    host, path = host_and_path(F.col(url))
    keyed = base.withColumn("_host", host).withColumn("_path", path)
    judged_hosts = reputation(keyed.select("_host"), outcomes.select(host.alias("_host"), "bad"))
    ruled = matched_rules(keyed, rules)
    method = F.when(F.col("lower") >= F.lit(BLOCK_AT), "block").otherwise("allow")
    return (
        keyed.join(judged_hosts.select("_host", "mean", "lower"), "_host", "left")
        .join(ruled, ["_host", "_path"], "left")
        .select(*base.columns, F.col("_host").alias("host"), F.col("_path").alias("path"), "rule",
                F.coalesce("rule_verdict", method).alias("verdict"),
                F.col("mean").alias("bad_mean"), F.col("lower").alias("bad_lower"))
    )
