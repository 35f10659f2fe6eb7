"""URL filters: host and path rules, and block decisions that follow redirects and canonical links.

A rule fits its host and all subdomains where the path starts with the rule's. Pages that redirect to each
other, or name each other as canonical, are one page under several addresses: they form components of a graph,
found in Spark, and a block of one address blocks its aliases. An address that a rule allows stays allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import host_of, path_of, stored
from reviewlens.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"
#: Up to so many rules become one expression; longer lists are a table that hosts and paths are joined to.
MOST_RULES = 200


@dataclass(frozen=True)
class Rule:
    """``name`` is the rule as written, host and path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse(text: str) -> Rule:
    """``block example.org/es/`` as a rule; the path begins with the first slash."""
    verdict, place = text.split()
    host, slash, rest = place.partition("/")
    if verdict not in (ALLOW, BLOCK) or not host or not slash:
        raise ValueError(f"not a rule: {text}")
    return Rule(verdict, host.lower(), slash + rest)


def _expression(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct<rule, verdict>; of equal ones an allow, then the last by name."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(set(rules), key=lambda r: (len(r.name), r.verdict == ALLOW, r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def decided(places: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    """``places`` with the rule that decides on their ``host`` and ``path`` as ``name``: struct<rule, verdict> or null.

    A long list is joined by key only: each different place meets the rules of its host and the domains above it
    at the lengths that the paths of these rules have, so a host with many pages and many rules makes no pairs of them.
    """
    if len(rules) <= MOST_RULES:
        return places.withColumn(name, _expression(F.col("host"), F.col("path"), rules))
    rows = sorted({(r.host, r.path, r.name, r.verdict) for r in rules})
    table = places.sparkSession.createDataFrame(rows, "rule_host string, rule_path string, rule string, verdict string")
    lengths = table.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    parts = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    different = places.select("host", "path").where("host is not null and path is not null").distinct()
    domains = different.select("host", "path", F.explode(above).alias("rule_host")).join(lengths, "rule_host")
    starts = domains.select("host", "path", "rule_host", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"))
    met = starts.withColumn("rule_path", F.expr("substring(path, 1, n)")).join(table, ["rule_host", "rule_path"])
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == ALLOW).alias("allows"), "rule", "verdict"))
    found = met.groupBy(F.col("host").alias("met_host"), F.col("path").alias("met_path")).agg(best.alias("best"))
    joined = places.join(found, (F.col("host") == F.col("met_host")) & (F.col("path") == F.col("met_path")), "left")
    chosen = F.when(F.col("best").isNotNull(), F.struct(F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")))
    return joined.select(*places.columns, chosen.alias(name))


def address(url: Column) -> Column:
    """What two spellings of an address share: the lower-cased host, the path and the query; no fragment, no scheme."""
    query = F.regexp_extract(url, r"(?s)^[^#?]*(\?[^#]*)", 1)
    path = path_of(url)
    return F.concat(host_of(url), F.when(path == "", F.lit("/")).otherwise(path), query)


def _resolved(link: Column, url: Column) -> Column:
    """A link as a whole url, seen from the page it stands on."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?\s*canonical\b)[^>]*?\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*?\burl\s*=\s*["']?\s*([^"'\s>]+)"""


def page_links(pages: DataFrame) -> DataFrame:
    """(u, v): addresses of pages and what they name as canonical or refresh to."""
    html = F.coalesce("html", F.lit(""))
    none = F.array().cast("array<string>")
    every = lambda word, expression: F.when(
        F.contains(F.lower(html), F.lit(word)), F.regexp_extract_all(html, F.lit(expression), F.lit(1))
    ).otherwise(none)
    named = F.array_distinct(F.concat(every("canonical", CANONICAL), every("refresh", REFRESH)))
    links = pages.where(F.contains("url", F.lit("://"))).select("url", F.explode(named).alias("link")).where("link <> ''")
    return links.select(
        address(F.col("url")).alias("u"), address(_resolved(F.replace("link", F.lit("&amp;"), F.lit("&")), F.col("url"))).alias("v")
    )


def blocked_aliases(links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(address) of every address in a component with an address that a rule blocks."""
    nodes = stored(connected_components(links), "address-components")
    as_url = F.concat(F.lit("//://"), F.col("node"))
    judged = decided(nodes.select("component", host_of(as_url).alias("host"), path_of(as_url).alias("path")), rules, "own")
    hit = judged.where(F.col("own.verdict") == BLOCK).select("component").distinct()
    return stored(nodes.join(hit, "component", "left_semi").select(F.col("node").alias("address")), "blocked-addresses")


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    The longest fitting rule decides. Where none fits, the page is blocked if its address shares a component
    with one that a rule blocks, through ``redirects`` (source, target urls) or the links in ``html``; else it
    is allowed. A null url, or one without ``://``, has empty host and path, no rule and no aliases. Repeated
    rows are judged one by one; other columns are not read.
    """
    links = page_links(pages.select("url", "html")) if "html" in pages.columns else None
    if redirects is not None:
        given = redirects.select(address(F.col("source")).alias("u"), address(F.col("target")).alias("v"))
        links = given if links is None else links.unionByName(given)
    url = F.col("url")
    places = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.when(F.contains(url, F.lit("://")), address(url)).alias("address")
    )
    judged = decided(places, rules, "own")
    if links is not None:
        aliases = blocked_aliases(links, rules).withColumnRenamed("address", "alias")
        judged = judged.join(aliases, F.col("address") == F.col("alias"), "left")
    else:
        judged = judged.withColumn("alias", F.lit(None).cast("string"))
    spread = F.when(F.col("alias").isNotNull(), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce("own.verdict", spread).alias("verdict")
    )
