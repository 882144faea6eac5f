"""URL rules, carried over redirects and canonical links.

Rules are matched by equality joins: a host gives its suffixes, a path the
prefixes of the lengths that the rules of that suffix have.  Pages that redirect to or
name one another as canonical are one page under several addresses; connected
components over those edges hand a block to every alias that no rule judges.
An explicit allow takes precedence: an address under an allow rule stays
allowed, and an alias class that holds one is not blocked by another member.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.llm.common import col, let, materialise
from snaplake.llm.components import connected_components

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tags that can name another address, from ``<`` to before ``>`` (or the next such end there is).
TAGS = r"""(?is)<(?:link|meta|base)\b[^>]*+"""
_QUOTED = r"""\s*+=\s*+["']?([^"'\s>]+)"""
# Each is matched inside one tag, from its first name on: no text is tried from more than one place.
CANONICAL = r"""(?is)\A(?>.*?<link\b)(?=.*\brel\s*+=\s*+["']?canonical\b).*\bhref""" + _QUOTED
REFRESH = (r"""(?is)\A(?>.*?<meta\b)(?=.*\bhttp-equiv\s*+=\s*+["']?refresh\b).*\bcontent\s*+=\s*+["']?\s*+[\d.]*+\s*+[;,]"""
           r"""\s*+url""" + _QUOTED)
#: A refresh without ``url=``, or with white space alone before its target.  The quote is group 1, the target group 2.
BARE_REFRESH = (r"""(?is)\A(?>.*?<meta\b)(?=.*\bhttp-equiv\s*+=\s*+["']?refresh\b).*\bcontent\s*+=\s*+"""
                r"""(?:(["'])\s*+[\d.]++(?>\s*+[;,]|\s++)\s*+|[\d.]++[;,])(?:url\s*+=\s*+)?+(?!\1)["']?([^"'\s>]+)""")
BASE = r"""(?is)\A(?>.*?<base\b).*\bhref""" + _QUOTED


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """An address as an alias node: host and path, with the query and without the fragment or the scheme."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), F.when(rest == "", F.lit("/")).otherwise(rest)))


def absolute(link: Column, url: Column) -> Column:
    """A link of a page as an address; other relative forms than ``//host/...`` and ``/path`` give none."""
    return (F.when(link.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"), address(link))
            .when(link.startswith("//"), address(F.concat(F.lit("x:"), link)))
            .when(link.startswith("/"), address(F.concat(F.lit("x://"), host_of(url), link))))


def without_dots(path: Column) -> Column:
    """A path from the root without its ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    def step(kept: Column, part: Column) -> Column:
        return (F.when(part == ".", kept).when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
                .otherwise(F.concat(kept, F.array(part))))

    # a dot segment at the end leaves the directory
    kept = lambda p: F.aggregate(F.filter(F.split(F.regexp_replace(p, r"/(\.\.?)\z", "/$1/"), "/", -1), lambda x, i: i > 0),
                                 F.array().cast("array<string>"), step)
    return let(path, lambda p: F.when(p.rlike(r"/\.\.?(/|\z)"), F.concat(F.lit("/"), F.array_join(kept(p), "/"))).otherwise(p))


def resolved(link: Column, url: Column) -> Column:
    """A link without a scheme or host as a full URL beside ``url``; any other link as it is."""
    query, own = F.regexp_extract(link, r"(?s)\A[^?#]*([^#]*)", 1), F.coalesce(F.nullif(path_of(url), F.lit("")), F.lit("/"))
    path = let(F.regexp_extract(link, r"(?s)\A([^?#]*)", 1), lambda way: F.when(way == "", own).otherwise(without_dots(
        F.when(way.startswith("/"), way).otherwise(F.concat(F.regexp_extract(own, r"(?s)\A(.*/)", 1), way)))))
    return (F.when(link.rlike(r"\A([A-Za-z][A-Za-z0-9+.-]*:|//)"), link)
            .when(link.startswith("#"), url).otherwise(F.concat(F.lit("x://"), host_of(url), path, query)))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) addresses from all canonical links and redirects in the pages.

    Relative ones are taken from the page's ``<base>``, or else its URL; those
    of other kinds (``mailto:x``) have no address.
    """
    url, html = col(url_col).cast("string"), col(html_col).cast("string")
    tagged = pages.select(url.alias("url"), F.regexp_extract_all(html, F.lit(TAGS), F.lit(0)).alias("tags")).filter(F.size("tags") > 0)

    def within(*patterns: tuple[str, int]) -> Column:
        return F.filter(F.flatten(F.transform("tags", lambda t: F.array(*[F.regexp_extract(t, p, g) for p, g in patterns]))),
                        lambda x: x != "")

    rows = tagged.select("url", F.get(within((BASE, 1)), F.lit(0)).alias("base"),
                         F.explode(within((CANONICAL, 1), (REFRESH, 1), (BARE_REFRESH, 2))).alias("link"))
    url = F.col("url")
    # entities of the only kind an address needs
    plain = lambda x: F.replace(x, F.lit("&amp;"), F.lit("&"))
    target = lambda link, at: let(let(link, lambda x: resolved(x, at)), lambda x: absolute(x, url))
    base = plain(F.col("base"))
    beside = F.coalesce(F.concat(F.lit("x://"), target(base, url)), url)
    dst = let(beside, lambda at: target(plain(F.col("link")), at))
    # in a Generate, so that no filter repeats it
    return rows.select(address(url).alias("src"), F.explode(F.array(dst)).alias("dst"))


def matched_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page, host, path) with the longest rule that fits as (rule, verdict), NULL where none does.

    A rule fits its host and all subdomains where the path starts with the
    rule's path; of two equally long ones, allow wins.
    """
    lengths = rules.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("lengths"))
    labels = F.split("host", r"\.", -1)
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)),
                         lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = (pages.filter("host <> ''").select("page", "host", "path", F.explode(suffix).alias("r_host")).join(lengths, "r_host")
            .select("page", "path", "r_host", F.explode("lengths").alias("n")).filter(F.length("path") >= F.col("n"))
            .select("page", "r_host", F.substring(F.col("path"), F.lit(1), F.col("n")).alias("r_path")))
    best = (keys.join(rules, ["r_host", "r_path"])
            .groupBy("page").agg(F.max(F.struct(F.length("rule").alias("n"), (F.col("r_verdict") == "allow").alias("a"),
                                                "rule", "r_verdict")).alias("best")))
    return pages.join(best, "page", "left").select("page", "host", "path", F.col("best.rule").alias("rule"),
                                                   F.col("best.r_verdict").alias("by_rule"))


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = RULES, redirects: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, alias) for every row of ``pages``.

    ``rules`` are (host, path, verdict); ``redirects`` (src, dst) are known
    redirects by URL, beside those the pages hold.  ``alias`` is the smallest
    address of the page's alias class, NULL for an address without links.  A
    NULL URL, or one without ``://``, has an empty host and path, no rule and no
    alias, and is allowed.  NULL HTML has no links.  Repeated rows and repeated
    or NULL ids stay, each row judged by its own URL.  An empty table gives an
    empty result.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"),
                         F.col("verdict").alias("r_verdict")).distinct()
    # written once: joins then know its size, and a small list is not met by shuffled pages
    rules = materialise(rules.withColumn("rule", F.concat("r_host", "r_path")), "url-rules")
    edges = page_links(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(address(F.col("src")).alias("src"), address(F.col("dst")).alias("dst")))
    found = materialise(connected_components(edges), "url-aliases")
    url = col(url_col).cast("string")
    rows = materialise(pages.select(F.monotonically_increasing_id().alias("page"), col(id_col).cast("long").alias("page_id"),
                                    host_of(url).alias("host"), path_of(url).alias("path"), address(url).alias("at")), "url-rows")
    # addresses that are only links have rules too
    known = found.select(F.col("node").alias("page"), F.regexp_extract("node", r"(?s)\A([^/?#]*)", 1).alias("host"),
                         F.regexp_extract("node", r"(?s)\A[^/?#]*([^?#]*)", 1).alias("path"))
    judged = matched_rules(known, rules).join(found, F.col("page") == F.col("node"))
    blocked = (judged.groupBy("component").agg(F.max(F.col("by_rule") == "block").alias("blocks"),
                                               F.max(F.col("by_rule") == "allow").alias("allows"))
               .select("component", (F.coalesce("blocks", F.lit(False)) & ~F.coalesce("allows", F.lit(False))).alias("blocked")))
    aliases = materialise(found.join(blocked, "component").select(F.col("node").alias("at"), F.col("component").alias("alias"), "blocked"),
                          "url-verdicts")
    base = matched_rules(rows.select("page", "host", "path"), rules).select("page", "rule", "by_rule")
    return (rows.join(base, "page").join(aliases, "at", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("by_rule", F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    "alias"))
