"""Empirical-Bayes reputation of hosts, from labelled outcomes of their pages.

The rate of bad pages of a host is shrunk towards that of its registered domain, that towards
its suffix, and that towards the rate of all labelled pages.  Each level is beta-binomial: the
parent's posterior mean is the mean of the prior, and the prior's weight (in pages) is estimated
by moments from the spread of the level's rates beyond what chance explains.  A host is blocked
if the lower bound of its posterior rate lies above a limit, so a host with few labelled pages
needs its domain or suffix to speak against it too.

Explicit rules (host and path, longest first) overrule the reputation.

Everything is DataFrame expressions: one aggregate per level (combined on the map side, so a
host with a third of all pages is no hot task) and a join back by host.

Defined cases: null urls and urls without ``://`` have an empty host and path, get no rule and
are judged like any host; hosts without labelled pages have their domain's posterior mean with
the prior's weight; without any label the rate is 0 and all is allowed; several outcomes of one
page count once each; repeated pages repeat; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules in the form (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
LIMIT = 0.25
Z = 1.6448536269514722  # one-sided 95 %
LEVELS = ("host", "domain", "suffix")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it has none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)
    return F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def parents(host: Column) -> tuple[Column, Column]:
    """Registered domain (the last two labels) and suffix (the last) of a host."""
    return F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, prefix = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(
            path, F.lit(slash + prefix))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def weight(groups: DataFrame) -> DataFrame:
    """One row: the prior's weight in pages from groups (n, bad, prior).

    Spread of the groups' rates around their priors against the spread inside groups, as in an
    analysis of variance; between 1 and 10,000 pages.
    """
    rate = F.col("bad") / F.col("n")
    sums = groups.where("n > 0").agg(
        F.count("*").alias("g"), F.sum("n").cast("double").alias("t"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("sq"),
        F.sum(F.col("n") * F.pow(rate - F.col("prior"), 2)).alias("between"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("inside"))
    msb = F.col("between") / F.greatest(F.col("g") - 1, F.lit(1))
    msw = F.col("inside") / F.greatest(F.col("t") - F.col("g"), F.lit(1.0))
    n0 = (F.col("t") - F.col("sq") / F.col("t")) / F.greatest(F.col("g") - 1, F.lit(1))
    total = msb + (n0 - 1) * msw
    rho = F.when(total > 0, (msb - msw) / total)
    return sums.select(F.greatest(F.lit(1.0), F.least(F.lit(10000.0), F.coalesce(
        F.when(rho > 0, 1 / rho - 1), F.lit(10000.0)))).alias("weight"))


def _scalar(one_row: DataFrame) -> Column:
    """The value of a frame of one row and column, as a scalar subquery."""
    return one_row.scalar()


def reputation(pages: DataFrame, outcome: str = "bad", host: str = "host") -> DataFrame:
    """host, n, bad, mean and lower bound of the posterior rate, for every host of ``pages``.

    ``outcome``: 1 bad, 0 good, null unlabelled.
    """
    name = F.coalesce(F.col(host), F.lit(""))
    counts = pages.select(name.alias("host"), F.col(outcome).alias("bad")).groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    domain, suffix = parents(F.col("host"))
    hosts = counts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    rate = suffixes.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)))

    def shrunk(groups: DataFrame) -> DataFrame:
        mass = _scalar(weight(groups))
        total = F.col("n") + F.col("mass")
        mean = (F.col("bad") + F.col("mass") * F.col("prior")) / total
        return groups.withColumn("mass", mass).withColumn("mean", mean).withColumn(
            "lower", F.greatest(F.lit(0.0), mean - F.lit(Z) * F.sqrt(
                F.greatest(F.lit(0.0), mean * (1 - mean)) / (total + 1))))

    level = shrunk(suffixes.withColumn("prior", _scalar(rate)))
    level = shrunk(domains.join(level.select("suffix", F.col("mean").alias("prior")), "suffix"))
    level = shrunk(hosts.join(level.select("domain", "suffix", F.col("mean").alias("prior")),
                              ["domain", "suffix"]))
    return level.select("host", "n", "bad", "mean", "lower")


def judge(pages: DataFrame, outcome: str = "bad", url: str = "url", page_id: str = "page_id",
          rules=RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate and bad_rate_low of every page."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), host.alias("host"),
                        path.alias("path"), F.col(outcome).alias("bad"))
    known = reputation(rows).select("host", "mean", "lower")
    found = rule_for(F.col("host"), F.col("path"), rules)
    return (rows.join(known, "host").withColumn("found", found).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("lower") > limit, "block").otherwise("allow"))
        .alias("verdict"),
        F.round("mean", 6).alias("bad_rate"), F.round("lower", 6).alias("bad_rate_low")))


def allowed(pages: DataFrame, **options) -> DataFrame:
    """Verdicts of the pages that pass."""
    return judge(pages, **options).where("verdict = 'allow'")


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages with ``bad``: 1 minus the quality label of the document the page shows.

    The number in a page's path is the id of its document; pages without one, or whose
    document has no label, have no outcome.
    """
    number = F.regexp_extract(F.col("url"), "://[^/?#]*/[^?#]*?([0-9]+)", 1).try_cast("long")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        (1 - F.min("quality")).alias("bad"))
    return (pages.select("page_id", "url", number.alias("doc_id")).join(marks, "doc_id", "left")
            .select("page_id", "url", "bad"))
