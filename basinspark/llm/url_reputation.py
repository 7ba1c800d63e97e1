"""URL filters: longest fitting rule first, else an empirical-Bayes reputation of the host.

Outcomes of labelled pages are counted per host. The prior of a host is a beta distribution around the rate of its
registered domain, that of a domain one around the rate of its suffix, and that of a suffix one around the rate of all
pages. The weight of each level's prior is estimated from the spread of its children (method of moments). A page is
blocked when the lower bound of the posterior probability of a bad outcome exceeds the limit.

Everything is DataFrame functions. Counts combine before their shuffles, so a host with a third of all pages is one
row of the reputation table.

Defined cases: a NULL url or one without ``://`` has an empty host and path, fits no rule, and is judged by the rate
of all pages; a host without labelled pages has the posterior of its domain, or else of its suffix, or else the rate of all
pages; with no labelled page at all nothing is blocked; repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basinspark.llm.common import ascii_lower, stored
from basinspark.session import broadcast_if_small


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains and all paths below ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Reputation:
    """Parameters of the posterior test."""

    limit: float = 0.5  # a page is blocked when its host is bad at this rate or more
    deviations: float = 1.645  # one-sided 95 % bound
    least_weight: float = 2.0  # bounds of the estimated prior weights, in pages
    most_weight: float = 1000.0
    long_suffixes: tuple[str, ...] = ("co.uk", "com.au", "co.jp", "com.br")  # suffixes of two labels


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a url, both empty without ``://``."""
    split = F.locate("://", url)
    rest = F.when(split > 0, F.substring(url, split + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)", 1)
    return ascii_lower(host), path


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The fitting rule with the longest name as a struct of name and verdict; NULL if none fits."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def domain_of(host: Column, long_suffixes: Sequence[str]) -> tuple[Column, Column]:
    """Registered domain and suffix of a host name; a host of one label is both."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    last_two = F.substring_index(bare, ".", -2)
    two = (F.size(labels) > 2) & last_two.isin(*long_suffixes) if long_suffixes else F.lit(False)
    suffix = F.when(two, last_two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(two, F.substring_index(bare, ".", -3)).otherwise(last_two)
    return domain, suffix


def _weight(children: DataFrame, key: str, params: Reputation) -> DataFrame:
    """Prior weight of each parent from the spread of its children's rates.

    With rates p of n pages each and their pooled rate m, a beta-binomial of weight w has a variance of
    m(1-m)(1+(n-1)/(w+1))/n. Solved for w with the page-weighted squared differences; a parent whose children agree
    gets the largest weight, one child gets the smallest.
    """
    totals = children.groupBy(key).agg(F.sum("bad").alias("all_bad"), F.sum("pages").alias("all_pages"))
    joined = children.join(totals, key)
    m = F.col("all_bad") / F.col("all_pages")
    spread = F.sum(F.col("pages") * F.pow(F.col("bad") / F.col("pages") - m, 2))
    sums = joined.groupBy(key).agg(
        F.first("all_bad").alias("all_bad"), F.first("all_pages").alias("all_pages"),
        spread.alias("spread"), F.count(F.lit(1)).alias("children"),
    )
    rate = F.col("all_bad") / F.col("all_pages")
    noise = rate * (1 - rate)
    correlation = (F.col("spread") - F.col("children") * noise) / (noise * (F.col("all_pages") - F.col("children")))
    weight = F.when((F.col("children") < 2), params.least_weight).when(
        (noise <= 0) | (F.col("all_pages") <= F.col("children")) | (correlation <= 0), params.most_weight
    ).otherwise(1 / correlation - 1)
    bounded = F.greatest(F.lit(params.least_weight), F.least(F.lit(params.most_weight), weight))
    return sums.select(key, F.col("all_bad").alias("bad"), F.col("all_pages").alias("pages"), bounded.alias("weight"))


def host_reputation(outcomes: DataFrame, params: Reputation = Reputation()) -> tuple[dict[str, DataFrame], float | None]:
    """Posterior means with the bound of the labelled hosts, domains and suffixes, by level, and the rate of all pages.

    ``outcomes`` has ``host`` and ``bad`` (0 or 1) for every labelled page. Each level is written once, with one row per
    name, as the next one and its own posterior are made from it; the rate of all pages is one row.
    """
    domain, suffix = domain_of(F.col("host"), params.long_suffixes)
    hosts = outcomes.groupBy("host").agg(F.sum("bad").alias("bad"), F.count("bad").alias("pages")).where("pages > 0")
    hosts, _ = stored(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "bad", "pages"), "hosts")
    owners = hosts.groupBy("domain").agg(F.first("suffix").alias("suffix"))
    domains, _ = stored(_weight(hosts, "domain", params).join(owners, "domain"), "domains")
    suffixes, _ = stored(_weight(domains.select("domain", "suffix", "bad", "pages"), "suffix", params), "suffixes")
    top = _weight(suffixes.select(F.lit(1).alias("every"), "bad", "pages"), "every", params).first()
    if top is None:
        none = hosts.select(F.col("host").alias("name"), F.col("pages").alias("labelled_pages"), F.lit(0.0).alias("bad_rate"), F.lit(0.0).alias("bad_bound"))
        return {level: none.withColumnRenamed("name", level) for level in ("host", "domain", "suffix")}, None

    def judged(rows: DataFrame, level: str) -> DataFrame:
        mean = (F.col("bad") + F.col("w") * F.col("rate")) / (F.col("pages") + F.col("w"))
        bound = mean - params.deviations * F.sqrt(mean * (1 - mean) / (F.col("pages") + F.col("w") + 1))
        own = [F.col("weight")] if level != "host" else []
        found = rows.select(level, F.col("pages").alias("labelled_pages"), mean.alias("bad_rate"), bound.alias("bad_bound"), *own)
        return stored(found, f"{level}-reputation")[0]

    def prior(rows: DataFrame, level: str) -> DataFrame:
        return broadcast_if_small(rows.select(F.col(level).alias("_of"), F.col("bad_rate").alias("rate"), F.col("weight").alias("w")))

    of_suffix = judged(suffixes.withColumns({"rate": F.lit(top["bad"] / top["pages"]), "w": F.lit(float(top["weight"]))}), "suffix")
    of_domain = judged(domains.join(prior(of_suffix, "suffix"), F.col("suffix") == F.col("_of")), "domain")
    of_host = judged(hosts.join(prior(of_domain, "domain"), F.col("domain") == F.col("_of")), "host")
    return {"host": of_host, "domain": of_domain.drop("weight"), "suffix": of_suffix.drop("weight")}, top["bad"] / top["pages"]


def nearest_reputation(pages: DataFrame, reputation: dict[str, DataFrame], params: Reputation) -> DataFrame:
    """One row per host of ``pages`` with its own posterior, or that of its domain, or that of its suffix."""
    domain, suffix = domain_of(F.col("host"), params.long_suffixes)
    hosts = pages.select("host").distinct().select("host", domain.alias("domain"), suffix.alias("suffix"))
    for level, found in reputation.items():
        own = found.select(level, F.struct("labelled_pages", "bad_rate", "bad_bound").alias(f"_{level}"))
        hosts = hosts.join(broadcast_if_small(own), level, "left")
    nearest = F.coalesce("_host", "_domain", "_suffix")
    return hosts.select("host", F.col("_host.labelled_pages").alias("labelled_pages"), nearest["bad_rate"].alias("bad_rate"), nearest["bad_bound"].alias("bad_bound"))


def judged_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], params: Reputation = Reputation(), page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per page: host, path, rule and verdict, with the host's reputation.

    ``outcomes`` has ``url`` and ``bad`` (0 or 1) of the labelled pages. A host without labelled pages is judged
    by its registered domain, then by its suffix, and then by the rate of all pages.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    parts = parts.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    seen = outcomes.where(F.col("bad").isNotNull()).select(url_parts(F.col("url"))[0].alias("host"), F.col("bad").cast("long").alias("bad"))
    reputation, rate = host_reputation(seen, params)
    # One row per host of the pages: broadcast where that is small, else joined by a shuffle that splits hot hosts.
    nearest, _ = stored(nearest_reputation(parts.where("host <> ''"), reputation, params), "nearest")
    joined = parts.join(broadcast_if_small(nearest), "host", "left").withColumn("_rate", F.lit(rate).cast("double"))
    bad = F.coalesce("bad_bound", "_rate", F.lit(0.0)) > params.limit
    return joined.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("labelled_pages", F.lit(0)).cast("long").alias("labelled_pages"),
        F.round(F.coalesce("bad_rate", "_rate"), 9).alias("bad_rate"),
    )
