"""URL filter with redirect equivalence.

Rules (host, path, allow or block) fit their host and all its subdomains where the path begins with the rule's path;
the longest rule wins. An address without a rule takes the verdict of its aliases: addresses that redirects,
canonical links and the canonical form of addresses connect are one class, found by distributed connected components.
A class with a blocked address blocks its unruled ones, unless an address of the class is explicitly allowed: allow
has precedence. Without either, the address is allowed.

Edges are: the page's canonical link and refresh target in its HTML, resolved against the page's address, edges given by the caller, and each address to its
canonical form (no scheme, fragment, tracking parameters, leading ``www.`` or final slash), which servers redirect to.

Rules are joined by host suffix, so they may be many; the counting of a class is combined before the shuffle.

Results by case: a null address, or one without ``://``, has empty host and path, no rule and is allowed (an address
that is not null still has its class). Rows of one address have the same verdict. A rule given twice, or as both allow
and block: allow wins. Pages without HTML have no links. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolscope.llm.common import connected_components, stored

ALLOW, BLOCK = "allow", "block"
CANONICAL = (r"""(?is)<link\b(?=[^>]*\srel\s*=\s*(?:"(?:[^">]*\s)?canonical["\s]|'(?:[^'>]*\s)?canonical['\s]|canonical[\s/>]))"""
             r"""[^>]*\shref\s*=\s*["']?\s*([^"'\s>]+)""")
BASE = r"""(?is)<base\b[^>]*\shref\s*=\s*["']?\s*([^"'\s>]+)"""
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?\s*([^"'\s>]+)"""
TRACKING = r"(^|&)(utm_[a-z]+|ref|gclid|fbclid)=[^&]*"


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_form(url: Column) -> Column:
    """Addresses of one form answer alike: ``host/path?query`` without what does not select the content."""
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&", "")
    bare = F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), F.regexp_replace(path_of(url), "/$", ""))
    return F.when(url.contains("://"), F.concat(bare, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))).otherwise(url)


def _ruled(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path`` and the longest fitting rule (``rule``, ``action``) of the addresses that have one."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    known = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action").filter("rule_host <> ''")
    fitting = addresses.select("host", "path", F.explode(suffixes).alias("rule_host")).join(known, "rule_host").filter(
        F.startswith("path", F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), (F.col("action") == ALLOW).alias("allowed")))
    return fitting.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", "best.rule", F.when(F.col("best.allowed"), ALLOW).otherwise(BLOCK).alias("action"))


def _undotted(path: Column) -> Column:
    """The path without its ``.`` and ``..`` parts."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    kept = F.array_join(F.aggregate(parts, F.slice(parts, 1, 0), step), "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.concat(kept, F.when(path.rlike(r"/\.\.?$"), "/").otherwise(""))).otherwise(path)


def resolved(target: Column, url: Column) -> Column:
    """The address that a link target of the page at ``url`` means; null if it means none (no address, other scheme)."""
    target = F.regexp_replace(target, r"(?i)&(amp|#38|#x26);", "&")
    start = F.regexp_extract(url, "^([^/?#]*:)//", 1)
    site = F.regexp_extract(url, "^([^/?#]*://[^/?#]*)", 1)
    folder = F.concat(F.regexp_extract(path_of(url), "^(.*/)", 1), F.lit(""))
    folder = F.when(folder == "", "/").otherwise(folder)
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    page = F.concat(site, path_of(url))
    path, rest = F.regexp_extract(target, "^([^?#]*)", 1), F.regexp_extract(target, "^[^?#]*(.*)$", 1)
    absolute = F.when(path.contains("://"), target).when(target.rlike(SCHEME), None)
    relative = (F.when(target.startswith("//"), F.concat(start, target))
                .when(target.startswith("/"), F.concat(site, _undotted(path), rest))
                .when(target.startswith("?"), F.concat(page, target))
                .when(target.startswith("#"), F.concat(page, query, target))
                .otherwise(F.concat(site, _undotted(F.concat(folder, path)), rest)))
    return F.when(target == "", None).when(path.contains("://") | target.rlike(SCHEME), absolute).when(site != "", relative)


def links_of(pages: DataFrame) -> DataFrame:
    """Canonical links and refresh targets of pages, as ``a`` (the page's address) and ``b``.

    Relative targets are resolved against the page's ``base`` if it has one, else its address.
    """
    html, low = F.col("html").cast("string"), _lower(F.col("html").cast("string"))
    found = F.array(
        F.when(low.contains("canonical"), F.regexp_extract(html, CANONICAL, 1)),
        F.when(low.contains("refresh"), F.regexp_extract(html, REFRESH, 1)),
    )
    rows = pages.filter("url IS NOT NULL AND html IS NOT NULL").select(
        F.col("url").cast("string").alias("a"), F.explode(F.filter(found, lambda x: x != "")).alias("target"),
        F.when(low.contains("<base"), F.regexp_extract(html, BASE, 1)).alias("base"))
    rows = rows.withColumn("base", F.coalesce(resolved(F.col("base"), F.col("a")), "a"))
    return rows.select("a", resolved(F.col("target"), F.col("base")).alias("b")).filter("b IS NOT NULL").distinct()


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``component`` of every page.

    ``rules`` has ``host``, ``path`` and ``action``; ``redirects`` has the addresses ``a`` and ``b``.
    """
    links = links_of(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL"))
    links = stored(links, "urls-links")
    urls = pages.select(F.col("url").cast("string").alias("url")).filter("url IS NOT NULL")
    urls = urls.union(links.select(F.explode(F.array("a", "b")))).distinct()
    urls = stored(
        urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                    canonical_form(F.col("url")).alias("form")), "urls-addresses")
    ruled = _ruled(urls.select("host", "path").distinct(), rules)
    # addresses and forms are nodes of their own kinds
    edges = urls.select(F.concat(F.lit("a:"), "url").alias("a"), F.concat(F.lit("f:"), "form").alias("b")).union(
        links.select(F.concat(F.lit("a:"), "a"), F.concat(F.lit("a:"), "b")))
    classes = connected_components(edges, "urls")
    known = urls.join(ruled, ["host", "path"], "left").join(classes, F.concat(F.lit("a:"), "url") == F.col("node"))
    known = stored(known.select("url", "host", "path", "rule", "action", "component"), "urls-ruled")
    verdicts = known.filter("action IS NOT NULL").groupBy("component").agg(
        F.min("action").alias("lowest"))  # "allow" sorts before "block"
    judged = known.join(verdicts, "component", "left").select(
        "url", "host", "path", "rule", "component", F.coalesce("action", "lowest", F.lit(ALLOW)).alias("verdict"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    return rows.join(judged, "url", "left").select(
        "page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule",
        F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"), "component")
