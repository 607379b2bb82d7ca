"""URL filter: rules first, else the reputation of the host.

Labelled page outcomes are shrunk by empirical Bayes through a hierarchy: the
overall share of bad pages is the prior mean of each suffix (last label of the
host), the suffix's posterior mean that of each registered domain (last two
labels), the domain's that of each host. The strength of each level's
beta-binomial prior comes from the spread of its groups by the method of
moments. A page is blocked where the lower posterior bound of its host's share
of bad pages exceeds the limit. DataFrame functions only.

Counts are pre-aggregated per host before anything is joined; pages meet their
host's row in an equi-join whose hot keys AQE splits.

Defined cases: a null url, or one without ``://``, has an empty host and path
and is judged as the host ``''``; a host without labelled pages has its
domain's reputation; without any label nothing is blocked; repeated pages are
judged and counted as often as they occur; a page with several labels counts as
bad if one of them is; null labels count as not bad. Repeated rows and null ids
of the labels add nothing; empty tables of pages give empty tables; further
columns, whatever their names, are left behind; of rules that fit, the longest
wins, and no two of one host and path exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxatlas.llm.common import columns

#: (rule, verdict): host and path, longest wins.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: A host is blocked when this many standard deviations below its posterior mean still exceed LIMIT.
DEVIATIONS, LIMIT = 1.645, 0.25
URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST, MOST = 0.001, 0.9  # bounds of the correlation inside a group


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 2), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, else null."""
    fits = []
    for rule, verdict in rules:
        h, _, p = rule.partition("/")
        ok = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        fits.append(F.when(ok, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits))


def _strength(groups: DataFrame) -> DataFrame:
    """One row: mean m and strength k of the prior over ``groups`` (n, bad)."""
    s = groups.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q"),
                   F.sum((F.col("n") * F.col("n")).cast("double")).alias("n2"), F.count("*").alias("g"))
    mean = F.col("bad") / F.col("n")
    within = F.col("m") * (1 - F.col("m"))
    s = s.withColumn("m", mean)
    spread = F.col("q") - 2 * F.col("m") * F.col("bad") + F.col("m") * F.col("m") * F.col("n")
    room = F.col("n") - F.col("n2") / F.col("n")
    rho = F.when((room > 0) & (within > 0), (spread - (F.col("g") - 1) * within) / (room * within)).otherwise(F.lit(LEAST))
    rho = F.least(F.greatest(rho, F.lit(LEAST)), F.lit(MOST))
    return s.select("m", (1 / rho - 1).alias("k"))


def reputations(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n_labelled, bad_mean, bad_low) for every host of ``pages``
    (page_id, host); ``labels``: doc_id, bad (boolean)."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    counted = pages.join(known, F.col("page_id") == F.col("doc_id"), "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    part = F.split("host", r"\.")
    h = counted.withColumns({"suffix": F.element_at(part, -1), "domain": F.concat_ws(".", F.slice(part, F.greatest(F.size(part) - 1, F.lit(1)), 2))})
    domains = h.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    ks, kd, kh = (F.broadcast(_strength(x.where("n > 0"))) for x in (suffixes, domains, h))  # one row each
    s = suffixes.join(ks).select("suffix", F.when(F.col("m").isNotNull(), (F.col("bad") + F.col("k") * F.col("m")) / (F.col("n") + F.col("k"))).alias("ms"))
    d = domains.join(s, "suffix").join(kd).select(
        "domain", F.when(F.col("ms").isNotNull(), (F.col("bad") + F.col("k") * F.col("ms")) / (F.col("n") + F.col("k"))).alias("md"))
    a, b = F.col("bad") + F.col("k") * F.col("md"), F.col("n") - F.col("bad") + F.col("k") * (1 - F.col("md"))
    total = F.col("n") + F.col("k")
    return h.join(d, "domain").join(kh).select(
        "host", F.col("n").alias("n_labelled"), F.coalesce(a / total, F.lit(0.0)).alias("bad_mean"),
        F.coalesce(a / total - DEVIATIONS * F.sqrt(F.greatest(a * b, F.lit(0.0)) / (total * total * (total + 1))), F.lit(0.0)).alias("bad_low"))


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_labelled, bad_mean, bad_low) for
    every row of ``pages`` (page_id, url). ``labels`` (doc_id, quality, toxic)
    tell the outcome of the page of the same id: bad if toxic or of quality 0."""
    p = columns(pages, page_id="long", url="string")
    p = p.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    own = columns(labels, doc_id="long", quality="int", toxic="int").select(
        "doc_id", F.coalesce((F.col("toxic") == 1) | (F.col("quality") == 0), F.lit(False)).alias("bad"))
    found = p.join(reputations(p, own), "host").withColumn("fit", rule_of(F.col("host"), F.col("path")))
    verdict = F.when(F.col("bad_low") > LIMIT, F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), verdict).alias("verdict"),
                        "n_labelled", F.round("bad_mean", 6).alias("bad_mean"), F.round("bad_low", 6).alias("bad_low"))
