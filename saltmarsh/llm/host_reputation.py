"""URL rules, and a host reputation for what no rule decides; DataFrame functions only.

Labelled outcomes of pages (bad or not) are summed per host.  Beta-binomial
priors shrink them level by level: all pages, suffix, registered domain, host.
A host is blocked when even the lower bound of its posterior share of bad
pages is above a limit, so a host with little evidence is let through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.shrinkage import strength
from saltmarsh.session import stored

#: Second-level names below which two-letter suffixes register domains.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]
BAD_SHARE = 0.5
Z = 1.645

Rule = tuple[str, str]  # verdict, and host with path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null and for urls without ``://``."""
    found = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(found, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; null if none does."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        fitting = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fitting)
    return fitting


def site_levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without its port; short hosts are their own domain and suffix."""
    labels = F.split(F.regexp_replace(host, ":[0-9]*$", ""), r"\.")
    last, second = F.element_at(labels, -1), F.try_element_at(labels, F.lit(-2))
    double = (F.length(last) == 2) & F.coalesce(second.isin(SECOND_LEVEL), F.lit(False))
    size = F.when(double, 2).otherwise(1)

    def tail(n: Column) -> Column:
        return F.array_join(F.slice(labels, F.greatest(F.size(labels) - n, F.lit(0)) + 1, n), ".")

    return tail(size + 1), tail(size)


def reputations(hosts: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``host``, ``bad_share`` (posterior mean) and ``bad_bound`` (its lower bound) of every host in ``hosts``.

    ``outcomes`` has one row per labelled page: ``host`` and ``bad`` (0 or 1).
    Sums combine map-side, so a host with a third of all pages is one row per
    task.  The bound is the mean less ``z`` standard deviations of the beta
    posterior.  Without outcomes every host has an even share of bad pages.
    """
    counted = outcomes.where("bad IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    domain, suffix = site_levels(F.col("host"))
    level = stored(
        hosts.select("host").distinct().join(counted, "host", "left")
        .select("host", domain.alias("domain"), suffix.alias("suffix"),
                F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad")), "host-outcomes")
    mean = (F.col("bad") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength"))

    def shrunk(groups: DataFrame) -> DataFrame:  # a one-row frame is joined, so nothing is multiplied
        return groups.join(F.broadcast(strength(groups.where("n > 0"), "bad")))

    def sums(*keys: str) -> DataFrame:
        return level.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    total = level.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("prior"))
    suffixes = shrunk(sums("suffix").join(F.broadcast(total))).select("suffix", mean.alias("prior"))
    domains = shrunk(sums("domain", "suffix").join(suffixes, "suffix")).select("domain", "suffix", mean.alias("prior"))
    sites = shrunk(level.join(domains, ["domain", "suffix"]))
    weight = F.col("n") + F.col("strength")
    spread = F.sqrt(mean * (1 - mean) / (weight + 1))
    return sites.select("host", mean.alias("bad_share"), (mean - z * spread).alias("bad_bound"))


def judge(pages: DataFrame, rules: list[Rule], outcomes: DataFrame | None = None, limit: float = BAD_SHARE) -> DataFrame:
    """Per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    The longest fitting rule decides; other pages are blocked when the lower
    bound of their host is above ``limit``.  Without ``outcomes`` the pages
    that a rule decides are the labelled ones, blocked ones being bad.  Null
    urls and those without ``://`` have an empty host, which is a host of its
    own.  An empty table gives no rows; other columns are not read.
    """
    host, path = url_parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    split = split.withColumn("found", longest_rule(rules, F.col("host"), F.col("path")))
    split = stored(split.select("page_id", "host", "path", "found.rule", F.col("found.verdict").alias("ruled")), "url-rules")
    if outcomes is None:
        outcomes = split.where("ruled IS NOT NULL").select("host", (F.col("ruled") == "block").cast("int").alias("bad"))
    known = stored(reputations(split, outcomes), "reputations")
    by_host = F.when(F.col("bad_bound") > limit, "block").otherwise("allow")
    return split.join(known, "host").select("page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"))
