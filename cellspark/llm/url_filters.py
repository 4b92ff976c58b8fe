"""URL filters: longest-rule verdicts, carried to aliases over redirect and canonical-link edges.

A rule is (host, path, verdict). It fits its host and all subdomains where the path starts with the rule's;
the longest rule text wins, then the longer host, then ``allow``. Pages that no rule fits take the verdict of
their component of aliases: ``allow`` if any alias is explicitly allowed, else ``block`` if any is blocked,
else ``allow``. Only DataFrame functions are used.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule, has no aliases and
is allowed; null or very long HTML has no or at most one canonical link and one refresh; repeated rows are
judged alike; an empty table gives an empty result; other columns are not read, so names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import components

RULE_SCHEMA = "host string, path string, verdict string"

# Query parameters that only track where a visit came from.
TRACKING = r"(?:utm_[a-z]+|gclid|fbclid|ref)=[^&]*"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """A URL without scheme, fragment and tracking parameters; null where it has no host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, rf"(?:^|&){TRACKING}", ""), "^&", "")
    tail = F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), tail))


def _resolved(link: Column, url: Column) -> Column:
    """A link as an absolute URL."""
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.lit("http:"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(link != "", F.concat(folder, link))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(``u``, ``v``): a page's node and the node its canonical link or its refresh points to."""
    html, url = F.col("html"), F.col("url")
    canonical = F.regexp_extract(html, r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    refresh = F.regexp_extract(html, r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    links = F.array(
        F.regexp_extract(canonical, r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1),
        F.regexp_extract(refresh, r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)", 1),
    )
    found = pages.where(html.rlike(r"(?i)canonical|http-equiv")).select("url", F.explode(links).alias("link")).where("link <> ''")
    targets = found.select(node_of(url).alias("u"), _resolved(F.col("link"), url).alias("target"))
    edges = targets.select("u", node_of(F.col("target")).alias("v"), host_of(F.col("target")).alias("host"), path_of(F.col("target")).alias("path"))
    return edges.where("u is not null and v is not null and u <> v").distinct()


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """For every distinct (``host``, ``path``) that a rule fits: the winning ``rule`` and its ``ruling``."""
    rules = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.concat("host", "path").alias("rule"), F.col("verdict").alias("ruling")
    )
    labels = F.split("host", r"\.")
    deepest = rules.agg(F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(1))).first()[0]
    # Only as many last labels as the longest rule host has can fit a rule.
    n = F.size(labels)
    ends = F.transform(F.sequence(F.greatest(n - (deepest - 1), F.lit(1)), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    suffixes = places.select("host", "path").where("host <> ''").distinct().withColumn("rule_host", F.explode(ends))
    fitting = suffixes.join(rules, "rule_host").where(F.startswith("path", F.col("rule_path")))
    rank = F.struct(F.length("rule"), F.length("rule_host"), (F.col("ruling") == "allow").cast("int"), F.col("rule"), F.col("ruling"))
    best = fitting.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.ruling").alias("ruling"))


def alias_verdicts(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(``node``, ``shared``): the verdict that a component of aliases gives to its members without a rule."""
    edges = alias_edges(pages)
    labels = components(edges.select("u", "v"))
    members = labels.select("node", "label").unionByName(labels.select(F.col("label").alias("node"), "label")).distinct()
    from_pages = pages.select(node_of(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    from_links = edges.select(F.col("v").alias("node"), "host", "path")
    places = from_pages.unionByName(from_links).distinct().join(members, "node")
    ruled = places.join(match_rules(places, rules), ["host", "path"])
    verdict = F.when(F.bool_or(F.col("ruling") == "allow"), "allow").otherwise("block")
    return members.join(ruled.groupBy("label").agg(verdict.alias("shared")), "label").select("node", "shared")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Per row ``page_id``, ``host``, ``path``, the fitting ``rule`` (or null) and the ``verdict``."""
    placed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node")
    )
    matched = placed.join(match_rules(placed, rules), ["host", "path"], "left")
    shared = matched.join(alias_verdicts(pages.select("url", "html"), rules), "node", "left")
    return shared.select("page_id", "host", "path", "rule", F.coalesce("ruling", "shared", F.lit("allow")).alias("verdict"))
