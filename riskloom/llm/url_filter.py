"""URL rules with decisions propagated over redirect and canonical-link equivalence.

A page's URL, what it redirects to and what it names as canonical are one resource.  These
pairs, and the normal form of each URL, are edges; distributed connected components make them
classes.  A URL that a rule fits has the rule's decision.  Any other takes its class's: allowed
if a member is allowed by a rule, else blocked if a member is blocked by one, else allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import cut
from riskloom.llm.components import connected_components


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
TRACKING = ("ref", "utm_[a-z]+", "gclid", "fbclid")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """A-Z lower-cased; empty for null and without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def normal_form(url: Column) -> Column:
    """host/path?query without scheme, fragment, tracking parameters, ``.html`` and a last slash; the
    whole URL if it has no host."""
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"(/index)?\.html?$", ""), r"/+$", "")
    asked = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    asked = F.regexp_replace(F.regexp_replace(asked, rf"(?i)(^|&)({'|'.join(TRACKING)})=[^&]*", ""), "^&", "")
    whole = F.concat(host_of(url), path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(F.lit("")))
    return F.when(host_of(url) == "", url).otherwise(whole)


def resolve(url: Column, link: Column) -> Column:
    """The absolute form of a link that stands in the page at ``url``."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, r"(?s)^(.*?://)", 1)
    root = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(F.concat(root, path_of(url)), r"(?s)^(.*?://[^/]*(?:/.*)?)/[^/]*$", 1)
    return (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(F.when(folder == "", root).otherwise(folder), F.lit("/"), link))
    )


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, target) for every row of ``pages`` (page_id, url, html).

    ``redirects`` (url, target) adds known redirects to those of the pages' refresh tags and canonical
    links.  ``target`` is the normal form of the URL.  A null URL or one without ``://`` has an empty host and path, fits no rule
    and, if it isn't linked, is allowed; null and empty html hold no links; repeated rows and pages of one
    URL are judged alike; an empty table gives no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    html = F.coalesce("html", F.lit(""))
    links = F.concat(F.regexp_extract_all(html, F.lit(_CANONICAL), F.lit(1)), F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(1)))
    seen = pages.select("page_id", "url", host.alias("host"), path.alias("path"), normal_form(F.col("url")).alias("node"), links.alias("links"))
    seen = cut(seen.select("*", name.alias("rule"), verdict.alias("ruled")), "pages")
    pairs = seen.select("url", "node", F.explode("links").alias("link")).where("url is not null").select("node", resolve(F.col("url"), F.col("link")).alias("to"))
    if redirects is not None:
        pairs = pairs.unionByName(redirects.select(normal_form(F.col("url")).alias("node"), F.col("target").alias("to")))
    pairs = cut(pairs.distinct().withColumn("v", normal_form(F.col("to"))), "url-edges")
    ends = pairs.select(F.col("v").alias("node"), rule_of(host_of(F.col("to")), path_of(F.col("to")), rules)[1].alias("ruled"))
    by_node = (
        seen.select("node", "ruled")
        .unionByName(ends)
        .where("ruled is not null and node is not null")
        .groupBy("node")
        .agg(F.bool_or(F.col("ruled") == "allow").alias("allow"), F.bool_or(F.col("ruled") == "block").alias("block"))
    )
    roots = connected_components(pairs.select(F.col("node").alias("u"), "v"))
    found = cut(by_node.join(roots, "node", "full").select("node", F.coalesce("root", "node").alias("root"), "allow", "block"), "url-classes")
    by_root = found.groupBy("root").agg(F.bool_or("allow").alias("allow"), F.bool_or("block").alias("block"))
    passed = found.join(by_root.where(~F.coalesce("allow", F.lit(False)) & F.col("block")).select("root"), "root").select("node", F.lit("block").alias("passed"))
    open_ones = seen.where("ruled is null").drop("links", "url").join(passed, "node", "left")  # rules decide the rest
    ruled = seen.where("ruled is not null").drop("links", "url").withColumn("passed", F.lit(None).cast("string"))
    both = open_ones.unionByName(ruled)
    return both.select("page_id", "host", "path", "rule", F.coalesce("ruled", "passed", F.lit("allow")).alias("verdict"), F.col("node").alias("target"))
