"""URL filter: explicit rules first, else the reputation of the host, by empirical Bayes.

Labelled pages are outcomes, good or bad. A host has few of them, so its rate of bad pages is shrunk: to the rate of its
registered domain, which is itself shrunk to that of its suffix, which is shrunk to the rate of all pages. At each level
the pull is a beta prior around the parent's rate; its weight (in pages) is estimated from how much more the outcomes
of that level's groups vary than a binomial would (beta-binomial moments). A host is blocked where its bad rate is
above `limit` even at the lower posterior bound: mean - `spread` * standard deviation.

Cases: a null url, or one without `://`, has an empty host and path and is judged as the host named ''. Null and
repeated page ids stay rows of their own; an outcome counts for each row with its page id. A page without outcomes, or
without a label table, gets what its domain, suffix or all pages say; with no outcome at all, everything is allowed.
Rules on one page: the longest wins, of equal ones the longer host, then block. Other columns are not read.

Every level is a grouped sum, combined before its shuffle, and hosts are joined back by `join_lookup`, which spreads
the pages of a host that holds many of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import fold, kept_table
from tidemill.operators.skew import join_lookup

Rule = tuple[str, str, str]
LIMIT = 0.3
SPREAD = 1.645
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10_000.0
#: Suffixes of two labels under which names are registered; every other suffix is the last label.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.kr",
                   "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.za")


def url_parts(url: Column | str = "url") -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty without `://`."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(fold(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    return host, F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column | str) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, user and port left out."""
    host = F.col(host) if isinstance(host, str) else host
    name = F.regexp_replace(F.regexp_replace(host, r"^[^@]*@", ""), r"[.]?(:[0-9]*)?$", "")
    labels = F.split(name, "[.]")
    tail = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
    numbers = name.rlike(r"^[0-9.]+$") | name.contains("[")
    double = tail(2).isin(*DOUBLE_SUFFIXES)
    suffix = F.when(numbers, name).when(double, tail(2)).otherwise(tail(1))
    return F.when(numbers, name).when(double, tail(3)).otherwise(tail(2)), suffix


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text (host + path) and action of the longest rule that fits, null where none does."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block"))
    text = action = None
    for kind, name, start in order:
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        text = F.when(fits, name + start) if text is None else text.when(fits, name + start)
        action = F.when(fits, kind) if action is None else action.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, action)


def _shrunk(groups: DataFrame) -> DataFrame:
    """groups: `n` outcomes, `k` bad ones, `parent` rate. Adds `rate`, the posterior mean, and the prior's `weight`."""
    m, n, k = F.col("parent"), F.col("n"), F.col("k")
    noise = m * (1 - m)
    total = groups.agg(F.sum((k - n * m) ** 2 - n * noise).alias("more"), F.sum(n * (n - 1) * noise).alias("room"))
    share = F.when(F.col("room") > 0, F.col("more") / F.col("room")).otherwise(0.0)
    lowest, highest = 1 / (MOST_WEIGHT + 1), 1 / (LEAST_WEIGHT + 1)
    weight = total.select((1 / F.least(F.greatest(share, F.lit(lowest)), F.lit(highest)) - 1).alias("w"))
    return groups.withColumn("weight", weight.scalar()).withColumn(
        "rate", (k + F.col("weight") * m) / (n + F.col("weight")))


def reputations(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """`host`, `n`, `k`, `rate`, `bound` of every host. pages: `page_id`, `host`; outcomes: `page_id`, `bad` (0 or 1)."""
    seen = outcomes.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(
        F.count("*").alias("n"), F.sum("bad").alias("k"))
    named = pages.join(seen, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))
    named = kept_table(named, "host-outcomes")
    domain, suffix = domain_of("host")
    hosts = named.withColumn("domain", domain).withColumn("suffix", suffix)
    sums = (F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    overall = suffixes.agg(F.when(F.sum("n") > 0, F.sum("k") / F.sum("n")).otherwise(0.0).alias("m"))
    suffixes = _shrunk(suffixes.withColumn("parent", overall.scalar()))
    up = suffixes.select("suffix", F.col("rate").alias("parent"))
    domains = _shrunk(domains.join(up, "suffix"))
    up = domains.select("domain", "suffix", F.col("rate").alias("parent"))
    hosts = _shrunk(hosts.join(up, ["domain", "suffix"]))
    size = F.col("n") + F.col("weight")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (size + 1))
    return hosts.select("host", "n", "k", "rate", (F.col("rate") - SPREAD * deviation).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], limit: float = LIMIT) -> DataFrame:
    """`page_id`, `host`, `path`, `rule`, `verdict`, and the host's `n`, `k`, `rate`, `bound` for every page."""
    host, path = url_parts("url")
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    known = kept_table(reputations(named.select("page_id", "host"), outcomes), "host-reputations")
    judged = join_lookup(named, known, "host", "left")
    rule, action = ruled(F.col("host"), F.col("path"), rules)
    own = F.when(F.round("bound", 9) > limit, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(action, own).alias("verdict"), "n", "k",
                         "rate", "bound")
