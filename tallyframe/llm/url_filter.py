"""Allow and block rules for URLs, carried along redirects and canonical links.

DataFrame functions only. A rule is a host and a path prefix; it fits its host and all subdomains.
URLs that are the same but for scheme, fragment and tracking parameters are one node; redirects and
canonical links of the pages connect nodes. A block decision on any URL of a connected component
holds for all of it, but an explicit allow rule of a URL comes first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise
from .components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that name a visit, not a page.
TRACKING = r"(?:utm_[^=&]*|gclid|fbclid)"
#: ``canonical`` may stand among other values of rel.
_LINK_TAG = (
    r"(?is)<link\b[^>]*\brel\s*=\s*(?:\"(?:[^\">]*\s)?canonical(?:\s[^\">]*)?\"|'(?:[^'>]*\s)?canonical(?:\s[^'>]*)?'"
    r"|canonical\b)[^>]*>"
)
_META_TAG = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'>\s]+)"
_AMPERSAND = "(?i)&(?:amp|#38|#x26);"
_REFRESH = r"(?is)\bcontent\s*=\s*[\"']?[^>]*?\burl\s*=\s*[\"']?([^\"'>\s]+)"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to a slash, question mark, hash or the end; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From behind the host to a question mark, hash or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def dot_free(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments, as browsers resolve them."""
    steps = F.aggregate(
        F.slice(F.split(path, "/"), 2, F.size(F.split(path, "/"))),
        F.lit(""),
        lambda way, step: F.when(step == ".", way)
        .when(step == "..", F.regexp_replace(way, "/[^/]*$", ""))
        .otherwise(F.concat(way, F.lit("/"), step)),
    )
    steps = F.when(path.rlike(r"/\.\.?$"), F.concat(steps, F.lit("/"))).otherwise(steps)
    return F.when(F.instr(path, "/.") > 0, steps).otherwise(path)


def node_of(url: Column) -> Column:
    """What the aliases of one address have in common; null without a host."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.btrim(F.regexp_replace(query, f"(?<![^&]){TRACKING}=[^&]*&?", ""), F.lit("&"))
    path = F.when(path_of(url) == "", "/").otherwise(dot_free(path_of(url)))
    node = F.concat(host_of(url), path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(host_of(url) != "", node)


def resolved(href: Column, base: Column) -> Column:
    """The address that ``href`` names on the page ``base``; null for a place on the page itself."""
    href = F.regexp_replace(href, _AMPERSAND, "&")
    scheme = F.substring_index(base, "://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_extract(path_of(base), "^(.*/)?", 0)
    return (
        F.when(href.isNull() | (href == "") | F.startswith(href, F.lit("#")), F.lit(None))
        .when(F.startswith(href, F.lit("?")), F.concat(root, path_of(base), href))
        .when(F.instr(F.regexp_extract(href, "^[^?#]*", 0), "://") > 0, href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), href))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target) of every canonical link and refresh redirect in the pages."""
    content = F.coalesce(F.col(html), F.lit(""))

    def found(tag: str, inner: str) -> Column:
        return F.transform(F.regexp_extract_all(content, F.lit(f"({tag})"), F.lit(1)),
                           lambda x: F.regexp_extract(x, inner, 1))

    hrefs = F.concat(found(_LINK_TAG, _HREF), found(_META_TAG, _REFRESH))
    return (
        pages.where(F.col(url).isNotNull() & F.col(html).isNotNull())
        .select(F.col(url).alias("url"), F.explode(hrefs).alias("href"))
        .select("url", resolved(F.col("href"), F.col("url")).alias("target"))
        .where(F.col("target").isNotNull())
    )


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, decision) for the distinct (host, path) that a rule fits.

    Every suffix of a host is looked up among the rules' hosts, so the number of rules is free. The
    longest rule that fits wins; among equals an allow.
    """
    parts = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), ".")
    )
    rank = F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("n"),
        (F.col("rule_decision") == "allow").alias("allow"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_decision").alias("decision"),
    )
    return (
        urls.select("host", "path").distinct()
        .withColumn("rule_host", F.explode(suffixes))
        .join(rules, "rule_host")
        .where(F.startswith(F.col("path"), F.col("rule_path")))
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", "best.rule", "best.decision")
    )


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (decision, host, path)."""
    rows = [(d, h.translate(str.maketrans(UPPER, LOWER)), p) for d, h, p in rules]
    return spark.createDataFrame(rows, "rule_decision string, rule_host string, rule_path string")


def filter_urls(
    pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, url: str = "url", html: str = "html"
) -> DataFrame:
    """All columns of ``pages`` plus host, path, rule, verdict (allow or block) and by (how it came).

    ``rules`` is (rule_decision, rule_host, rule_path), of any number, as :func:`rule_table` gives.
    ``links`` (url, target) are the redirects and canonical links; by default those in the pages'
    html. A URL that a rule fits gets the longest rule's decision (by = rule). Another is blocked
    if its component of aliases holds a URL that a rule blocks (by = alias), else allowed (by null).

    A null url, or one without ``://``, has an empty host and path, fits no rule with a host, has
    no aliases and is allowed. Null html holds no links. Repeated rows get equal verdicts. Columns
    named like the added ones are replaced. Empty tables give empty results; without rules all
    pages are allowed.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "by")
    links = page_links(pages, url, html) if links is None else links.select("url", "target")
    links = materialise(links.distinct(), "url-links")
    # the page's own columns travel as one, so that they may have any name
    judged = pages.select(
        F.struct("*").alias("page"),
        F.coalesce(host_of(F.col(url)), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col(url)), F.lit("")).alias("path"),
        node_of(F.col(url)).alias("node"),
    )
    every = pages.select(F.col(url).alias("u")).unionByName(links.select(F.col("target").alias("u")))
    seen = every.where(F.col("u").isNotNull()).select(
        host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"), node_of(F.col("u")).alias("node")
    ).distinct()
    decided = materialise(decide(seen, rules), "url-decisions")
    blocked = seen.join(decided.where(F.col("decision") == "block"), ["host", "path"]).select("node").distinct()
    groups = materialise(
        connected_components(links.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"))),
        "url-groups",
    )
    bad = groups.join(blocked, "node").select("component").distinct()
    aliases = groups.join(bad, "component").select("node").unionByName(blocked.select("node")).distinct()
    aliases = materialise(aliases.where(F.col("node").isNotNull()).withColumn("alias", F.lit(True)), "url-aliases")
    return (
        judged.join(decided, ["host", "path"], "left")
        .join(aliases, "node", "left")
        .select(
            *[F.col("page")[c].alias(c) for c in pages.columns], "host", "path", "rule",
            F.coalesce("decision", F.when(F.col("alias"), "block"), F.lit("allow")).alias("verdict"),
            F.when(F.col("decision").isNotNull(), "rule").when(F.col("alias"), "alias").alias("by"),
        )
    )
