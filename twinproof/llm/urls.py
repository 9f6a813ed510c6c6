"""URL filters whose decisions reach aliases of a page.

A page's url is judged by the longest rule that fits its host and path. Pages that redirect to one another or name
one canonical url are aliases: their urls are the nodes of a graph, and a url without a rule takes the decision of
its connected component. Within a component an explicit allow goes before a block; a component without any rule,
and a url without aliases, is allowed.

Defined cases: a url that is NULL or has no ``://`` has an empty host and path and fits no rule; NULL html has no
links; repeated pages are judged alike; links to urls outside the table count, rules of theirs included; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinproof.llm.components import connected_components
from twinproof.llm.tables import written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
]


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What two addresses of one resource have in common: host, path (at least ``/``) and query. NULL without ``://``."""
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), path, query))


def rule_of(host: Column, path: Column, rules: list[UrlRule] = RULES) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits, else NULLs. Rules are configuration: a few, not data."""
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        chosen = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _absolute(target: Column, url: Column) -> Column:
    """A link's target as a url, read relative to the page's."""
    root = F.concat(F.lit("http://"), host_of(url))
    folder = F.regexp_replace(path_of(url), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when((target == "") | target.startswith("#") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(root, path_of(url), target))
        .otherwise(F.concat(root, folder, target))
    )


_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_REFRESH = r"""(?is)\bcontent\s*=\s*(?:"[^";]*;\s*url\s*=\s*'?([^"']*)|'[^';]*;\s*url\s*=\s*"?([^"']*))"""


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(from_url, to_url)`` of canonical links and of redirects in the head of pages."""
    some = pages.where(F.col(html).rlike(r"(?i)canonical|http-equiv") & F.col(url).contains("://")).select(F.col(url).alias("from_url"), F.col(html).alias("html"))
    bare = F.regexp_replace(F.regexp_replace("html", r"(?s)<!--.*?-->", ""), r"(?is)<script\b.*?</script>", "")
    tags = some.select("from_url", F.explode(F.regexp_extract_all(bare, F.lit(r"(?is)<(?:link|meta)\b(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>"), F.lit(0))).alias("tag"))
    first = lambda pattern, groups: F.coalesce(*[F.nullif(F.regexp_extract("tag", pattern, g), F.lit("")) for g in groups])
    canonical = F.when(F.col("tag").rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b"), first(_HREF, (1, 2, 3)))
    refresh = F.when(F.col("tag").rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"), first(_REFRESH, (1, 2)))
    target = F.trim(F.replace(F.coalesce(canonical, refresh), F.lit("&amp;"), F.lit("&")))
    return tags.select("from_url", _absolute(target, F.col("from_url")).alias("to_url")).where("to_url IS NOT NULL")


def alias_verdicts(links: DataFrame, rules: list[UrlRule] = RULES) -> DataFrame:
    """``(node, verdict)`` that each linked url takes from its component; NULL where the component has no rule."""
    ends = written(links.select("from_url", "to_url", node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b")), "url-links")
    members = connected_components(ends, "a", "b")
    urls = ends.select(F.col("a").alias("node"), F.col("from_url").alias("url")).unionByName(ends.select(F.col("b").alias("node"), F.col("to_url").alias("url")))
    own = urls.select("node", rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)["verdict"].alias("own")).distinct()
    decided = members.join(own, "node").groupBy("root").agg(F.max(F.col("own") == "allow").alias("allow"), F.max(F.col("own") == "block").alias("block"))
    verdict = F.when(F.col("allow"), "allow").when(F.col("block"), "block")
    return written(members.join(decided, "root").select("node", verdict.alias("alias_verdict")), "url-verdicts")


def judge_urls(pages: DataFrame, rules: list[UrlRule] = RULES, redirects: DataFrame | None = None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row of ``pages``: ``page_id, host, path, rule, verdict``. ``redirects`` adds known ``(from_url, to_url)``."""
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    at = F.col(url)
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(at).alias("host"), path_of(at).alias("path"), node_of(at).alias("node"))
    rows = rows.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    judged = rows.join(alias_verdicts(links, rules), "node", "left")
    return judged.select("page_id", "host", "path", F.col("own.rule").alias("rule"), F.coalesce("own.verdict", "alias_verdict", F.lit("allow")).alias("verdict"))
