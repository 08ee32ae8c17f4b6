"""URL filter by empirical-Bayes host reputation (built-in expressions only).

Labelled page outcomes are counted by host, registered domain and suffix. From
the suffix down, each level's rate of bad pages is shrunk to its parent's with
a beta prior; the prior's weight is fitted from the level's own spread by the
method of moments. A host is blocked if a lower bound of its posterior bad rate
passes ``max_bad``. Explicit rules (host, path) come first; the longest wins.

Defined cases: a null or malformed url has empty host and path and is judged by
the corpus prior; a page without label counts for no outcome; repeated page or
label rows count each time; hosts without any label stand at their domain's
rate; with no labels at all the prior rate is 1/2 and nothing is blocked; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# fixed values: suffixes of two labels under which names are registered
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")

MAX_BAD = 0.5      # block when the posterior bound of the bad rate is above
Z = 1.645          # one-sided 95 % bound
LEAST_RHO, MOST_RHO = 1 / 1001, 1 / 2   # prior weights from 1000 down to 1

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
                       UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label more; whole host if shorter
    or if it ends in a number (an address)."""
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    return (F.when(host.rlike(r"(^|\.)[0-9]+(:[0-9]+)?$"), host)
            .when(two.isin(*TWO_LABEL_SUFFIXES), three).otherwise(two))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return (F.when(host.rlike(r"(^|\.)[0-9]+(:[0-9]+)?$"), F.lit(""))
            .when(two.isin(*TWO_LABEL_SUFFIXES), two)
            .otherwise(F.substring_index(host, ".", -1)))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does.
    ``rules`` is a short fixed list of (verdict, host, path)."""
    fit = F.coalesce(*[
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    ]) if rules else F.lit(None).cast("struct<rule:string,verdict:string>")
    return fit


def _rho(level: DataFrame, total: str, bad: str, mean: str) -> float:
    """Share of variance between the level's groups (beta-binomial, by moments):
    one row of sums comes to the driver, whatever the size."""
    p = F.col(mean) * (1 - F.col(mean))
    rate = F.col(bad) / F.col(total)
    row = level.where(F.col(total) > 0).agg(
        F.sum(F.col(total) * (rate - F.col(mean)) * (rate - F.col(mean))).alias("s"),
        F.sum(p).alias("p"),
        F.sum(p * (F.col(total) - 1)).alias("q"),
    ).first()
    if not row["q"]:
        return LEAST_RHO
    return min(MOST_RHO, max(LEAST_RHO, (row["s"] - row["p"]) / row["q"]))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Posterior of every host in ``pages`` (page_id, host): host, n, bad,
    alpha, beta, bound. ``outcomes`` (page_id, bad 0/1) are the labelled pages."""
    # labelled rows only meet the labels; hosts are counted before any further join
    labelled = pages.join(outcomes.select(F.col("page_id").alias("_id"), "bad"),
                          F.col("page_id") == F.col("_id"), "left")
    hosts = written(
        labelled.groupBy("host").agg(F.count("bad").alias("n"),
                                     F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}),
        "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("bad").alias("db"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("sn"), F.sum("bad").alias("sb"))
    all_n, all_bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    prior = (all_bad + 1) / (all_n + 2)

    def weight(rho: float) -> float:
        return 1 / rho - 1

    suffixes = suffixes.withColumn("p0", F.lit(prior))
    k = weight(_rho(suffixes, "sn", "sb", "p0"))
    suffixes = suffixes.select(F.col("suffix").alias("_s"),
                               ((F.col("sb") + k * F.col("p0")) / (F.col("sn") + k)).alias("sm"))
    domains = domains.join(suffixes, F.col("suffix") == F.col("_s"))
    k = weight(_rho(domains, "dn", "db", "sm"))
    domains = domains.select(F.col("domain").alias("_d"), F.col("suffix").alias("_ds"),
                             ((F.col("db") + k * F.col("sm")) / (F.col("dn") + k)).alias("dm"))
    hosts = hosts.join(domains, (F.col("domain") == F.col("_d")) & (F.col("suffix") == F.col("_ds")))
    k = weight(_rho(hosts, "n", "bad", "dm"))
    a, b = F.col("bad") + k * F.col("dm"), F.col("n") - F.col("bad") + k * (1 - F.col("dm"))
    mean = F.col("alpha") / (F.col("alpha") + F.col("beta"))
    return (
        hosts.select("host", "n", "bad", a.alias("alpha"), b.alias("beta"))
        .withColumn("bound", mean - Z * F.sqrt(mean * (1 - mean) / (F.col("alpha") + F.col("beta") + 1)))
    )


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]],
               max_bad: float = MAX_BAD) -> DataFrame:
    """Per page row (page_id, url): page_id, host, path, rule, verdict. Host
    verdicts join back on the host; Spark splits a hot host's rows (AQE)."""
    url = F.col("url")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    known = host_reputation(parts.select("page_id", "host"), outcomes).select(
        F.col("host").alias("_h"),
        F.when(F.col("bound") > max_bad, "block").otherwise("allow").alias("_verdict"))
    fit = rule_of(F.col("host"), F.col("path"), rules)
    return (
        parts.join(known, F.col("host") == F.col("_h"), "left")
        .withColumn("_fit", fit)
        .select("page_id", "host", "path", F.col("_fit.rule").alias("rule"),
                F.coalesce(F.col("_fit.verdict"), F.col("_verdict")).alias("verdict"))
    )
