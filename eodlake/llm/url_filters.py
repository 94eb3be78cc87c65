"""URL block and allow rules, with decisions carried over redirect and canonical-link edges.

A rule fits its host, all subdomains, and every path that starts with its own; the longest rule wins.
Pages and link targets are nodes; connected components over the edges are aliases of one resource. A
page without a rule of its own takes block from its component, unless a member is allowed by a rule:
explicit allow comes first. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodlake.llm.common import ascii_lower, cut
from eodlake.llm.components import components

#: Up to so many rules are sent to every task; more are joined by shuffle, spread over SALTS copies.
BROADCAST_RULES = 50_000
SALTS = 16

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_LINK = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?\s*canonical\b)[^>]*?\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_REFRESH = (
    r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b)[^>]*?\bcontent\s*=\s*[\"']?[^\"'>]*?url\s*=\s*([^\"'\s>]+)"
)


def host(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or no `://`."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _SPLIT, 1)), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty for null or no `://`."""
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def key(url: Column) -> Column:
    """What aliases share: host, path and query, without scheme and fragment; null if there is no host."""
    return F.when(host(url) != "", F.concat(host(url), path(url), F.regexp_extract(url, _SPLIT, 3)))


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of every distinct (host, path); rule and verdict are null if none fits.

    rules: (host, path, action allow or block). Of equally long rules the one with the longer host wins,
    of the same rule given twice allow wins. Rules with a null in any column fit nothing.
    """
    rules = rules.select(
        ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("action").alias("action")
    ).dropna()
    nodes = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    spread = nodes.select("host", "path", F.explode(suffixes).alias("rule_host"))
    if rules.count() <= BROADCAST_RULES:
        joined = spread.join(F.broadcast(rules), "rule_host", "left")
    else:
        salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = spread.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(
            salted, ["rule_host", "salt"], "left"
        )
    fits = F.col("rule_path").isNotNull() & F.startswith("path", F.col("rule_path"))
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule), F.length("rule_host"), -F.length("action"), rule.alias("rule"), F.col("action").alias("action"))
    best = joined.groupBy("host", "path").agg(F.max(F.when(fits, rank)).alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("verdict"))


def _absolute(base: Column, target: Column) -> Column:
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    folder = F.regexp_extract(path(base), r"(?s)^(.*/)", 1)
    return (
        F.when(F.contains(target, F.lit("://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(scheme, F.lit("://"), host(base), target))
        .otherwise(F.concat(scheme, F.lit("://"), host(base), F.when(folder == "", "/").otherwise(folder), target))
    )


def link_edges(pages: DataFrame) -> DataFrame:
    """(url, target) of every canonical link and refresh redirect in the html of `pages` (url, html)."""
    found = pages.select("url", "html").where(F.col("html").rlike(r"(?i)canonical|refresh"))
    targets = F.concat(F.regexp_extract_all("html", F.lit(_LINK), 1), F.regexp_extract_all("html", F.lit(_REFRESH), 1))
    return found.select("url", F.explode(targets).alias("target")).select(
        "url", _absolute(F.col("url"), F.col("target")).alias("target")
    )


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages` (page_id, url, html).

    redirects: further edges (url, target), such as a crawl's redirect log. Null urls and urls without
    `://` have an empty host and path, no rule, no aliases, and are allowed. Null html has no links.
    Repeated rows stay; further columns of `pages` are not read.
    """
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.union(redirects.select("url", "target"))
    edges = edges.select("url", "target").dropna()
    ends = edges.select(key(F.col("url")).alias("u"), key(F.col("target")).alias("v"))
    members = components(ends)
    here = pages.select(
        "page_id",
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
        key(F.col("url")).alias("node"),
    )
    linked = edges.select("url").union(edges.select(F.col("target").alias("url")))
    linked = linked.select(key(F.col("url")).alias("node"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path")).distinct()
    known = decide(here.select("host", "path").union(linked.select("host", "path")), rules)
    aliases = members.join(linked, "node").join(known, ["host", "path"])
    blocked = cut(
        aliases.groupBy("root")
        .agg(F.max((F.col("verdict") == "block").cast("int")).alias("block"), F.max((F.col("verdict") == "allow").cast("int")).alias("allow"))
        .where("block = 1 and allow = 0")
        .join(members, "root")
        .select("node", F.lit(True).alias("by_alias"))
    )
    return (
        here.join(known, ["host", "path"])
        .join(blocked, "node", "left")
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("verdict", F.when(F.col("by_alias"), "block"), F.lit("allow")).alias("verdict"),
        )
    )
