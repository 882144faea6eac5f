import re

import pytest

from snaplake.llm.url_filter import RULES, absolute, page_links, resolved, url_filter
from pyspark.sql import functions as F


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")


def best(url, rules=RULES):
    host, path = parts(url)
    fit = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (max(fit)[2], max(fit)[3]) if fit else (None, None)


URLS = [None, "", "nothing", "http://", "http:///en/x", "https://example.com/en/1", "https://WWW.Example.com/en/1?x=/en/", "ftp://a.b.net/fr/",
        "http://net/es/1", "http://notnet/es/1", "http://x.example.com/en", "http://x.example.com", "http://a://b.net/es/", "//x.net/es/",
        "http://é.com/", "http://.com/", "http://com./x", "http://a.example.com/en/#f", "http://a.net?/fr/", "x" * 5000 + "://a.net/fr/" + "y" * 5000]


@pytest.fixture
def pages(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(i, u, h, "c", 0) for i, u, h in rows],
                                     "page_id long, url string, html string, host string, page int").repartition(parts)
    return make


def test_rules_match_brute_force(pages):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(5, URLS[5], ""), (5, URLS[5], ""), (None, URLS[7], "x")]
    got = url_filter(pages(rows)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, str(x))
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=key) == sorted(
        ((i, *parts(u), best(u)[0], best(u)[1] or "allow") for i, u, _ in rows), key=key)


def canonical(url):
    return f'<html><link type=x rel="canonical" href="{url}"><body>'


def refresh(url):
    return f"<META HTTP-EQUIV='refresh' content='0; URL={url}'>"


def test_blocks_reach_aliases_and_allows_go_before(pages):
    rows = [(1, "http://a.org/1", canonical("http://x.net/fr/1")), (2, "http://b.org/2", refresh("http://a.org/1")),
            (3, "http://x.net/fr/1", ""), (4, "http://c.com/4", canonical("http://x.net/fr/1")),  # an allow in the class
            (11, "http://a.org/11", canonical("//y.net/es/1")), (12, "https://b.org/12#top", canonical("http://a.org/11")),
            (13, "http://b.org/13", "<p>"), (14, "http://d.org/14", canonical("/13")), (15, "http://d.org/13", refresh("http://b.org/12")),
            (16, "http://e.org/?a=1&b=2", canonical("http://y.net/es/1?q=1&amp;r=2")), (17, "http://f.org", canonical("rel/ative")),
            (18, "http://g.org/", None), (19, "http://h.org", canonical("http://g.org"))]
    got = {r.page_id: r.verdict for r in url_filter(pages(rows)).collect()}
    assert {i for i, v in got.items() if v == "block"} == {3, 11, 12, 14, 15, 16}
    more = pages([(100, "http://z.org/", "")]).sparkSession.createDataFrame([("http://g.org/", "http://y.net/es/1")], "src string, dst string")
    assert {r.page_id for r in url_filter(pages(rows), redirects=more).collect() if r.verdict == "block"} == {3, 11, 12, 14, 15, 16, 18, 19}


def test_a_chain_and_a_hub_of_aliases(pages):
    rows = [(i, f"http://a.org/{i}", canonical(f"http://a.org/{i + 1}")) for i in range(40)] + [(40, "http://a.org/40", refresh("http://q.net/fr/"))]
    rows += [(100 + i, f"http://hub.org/{i}", canonical("http://r.net/es/")) for i in range(60)]
    got = url_filter(pages(rows)).collect()
    assert all(r.verdict == "block" for r in got) and len(got) == len(rows)


def test_own_rules_and_empty_tables(pages, spark):
    rules = [("a.org", "/x", "block"), ("a.org", "/xy", "allow"), ("org", "", "block"), ("a.org", "/x", "allow")]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter(pages([(1, "http://a.org/xy", ""), (2, "http://b.a.org/xz", ""), (3, "http://b.org", "")]), rules).collect()}
    assert got == {1: ("a.org/xy", "allow"), 2: ("a.org/x", "allow"), 3: ("org", "block")}
    assert url_filter(pages([(1, "x", "")]).limit(0)).collect() == []
    assert page_links(pages([(1, "http://a.org/", canonical("mailto:x"))])).select(F.count("dst")).first()[0] == 0
    assert spark.range(1).select(absolute(F.lit("?q"), F.lit("http://a.org/"))).first()[0] is None


BASE, RELATIVE = "http://a.org/b/c/d;p?q", {  # from RFC 3986, 5.4, without fragments
    "g": "a.org/b/c/g", "./g": "a.org/b/c/g", "g/": "a.org/b/c/g/", "/g": "a.org/g", "//g": "g/", "?y": "a.org/b/c/d;p?y", "g?y": "a.org/b/c/g?y",
    "#s": "a.org/b/c/d;p?q", "g#s": "a.org/b/c/g", ".": "a.org/b/c/", "./": "a.org/b/c/", "..": "a.org/b/", "../g": "a.org/b/g", "../..": "a.org/",
    "../../../g": "a.org/g", "/./g": "a.org/g", "/../g": "a.org/g", "g.": "a.org/b/c/g.", "..g": "a.org/b/c/..g", "./../g": "a.org/b/g",
    "g/./h": "a.org/b/c/g/h", "g/../h": "a.org/b/c/h", "g;x=1/../y": "a.org/b/c/y", "g?y/../x": "a.org/b/c/g?y/../x", "g#s/../x": "a.org/b/c/g",
    "http://h.org/x": "h.org/x", "mailto:x": None, "a//../b": "a.org/b/c/a/b", "/..//g": "a.org//g"}


def test_relative_links_resolve(spark):
    rows = spark.createDataFrame([(k, BASE) for k in RELATIVE] + [("x", "http://a.org"), ("y", "http://a.org//z"), ("?q", "http://a.org")], "l string, u string")
    got = [(r.l, r.at) for r in rows.select("l", absolute(resolved(F.col("l"), F.col("u")), F.col("u")).alias("at")).collect()]
    assert got == [*RELATIVE.items(), ("x", "a.org/x"), ("y", "a.org//y"), ("?q", "a.org/?q")]


def test_every_link_of_a_page_counts(pages):
    meta = lambda content: f"<meta http-equiv=refresh content={content}>"
    html = {1: canonical("http://p.org/") + canonical("http://q.org/"), 2: refresh("http://p.org/") + refresh("http://q.org/"),
            3: meta("'0; http://p.org/'"), 4: meta("'0 http://p.org/'"), 5: meta('"0 ; url=\'p\'"'), 6: meta("0;p?a=1"), 7: meta("'0'"), 8: meta("'0; url='"),
            9: "<meta content=0; http-equiv=refresh>", 10: "<meta content='5 'name=x http-equiv=refresh>", 11: '<base href="/up/x">' + canonical("p"),
            12: '<base target=x href="http://p.org/up/">' + refresh("../q"), 13: meta("'0 , url.html'"), 14: canonical("?a=1&amp;b=2")}
    want = {1: {"p.org/", "q.org/"}, 2: {"p.org/", "q.org/"}, 3: {"p.org/"}, 4: {"p.org/"}, 5: {"o.org/d/p"}, 6: {"o.org/d/p?a=1"}, 11: {"o.org/up/p"},
            12: {"p.org/q"}, 13: {"o.org/d/url.html"}, 14: {"o.org/d/14?a=1&b=2"}}
    got = {}
    for r in page_links(pages([(i, f"http://o.org/d/{i}", h) for i, h in html.items()])).collect():
        got.setdefault(int(r.src.rsplit("/", 1)[1]), set()).add(r.dst)
    assert got == want


def test_blocks_reach_aliases_over_relative_links(pages):
    rows = [(1, "http://x.net/fr/1", ""), (2, "http://x.net/a/2", canonical("../fr/1")), (3, "http://x.net/a/b/3?x", refresh("../2")),
            (4, "http://x.net/a/4", canonical("http://y.org/") + canonical("2")), (5, "http://x.net/a/5", "<meta http-equiv=refresh content='0; 4'>"),
            (6, "http://x.net/a/6", canonical("6?y"))]
    assert {r.page_id for r in url_filter(pages(rows)).collect() if r.verdict == "block"} == {1, 2, 3, 4, 5}


def test_pages_full_of_unclosed_tags_take_time_in_proportion(pages):
    import time

    def page(part, size, tail=""):
        return part * (size // len(part)) + tail
    link = ' <link rel=canonical href="http://x.net/fr/1">'
    parts = ["<link ", "<meta http-equiv=refresh content=", "<base href", "<link rel=canonical href ", "content=  ", "<meta ", " ", "<"]
    rows = [(i, f"http://a{i}.org/", page(p, 5_000_000, ">" + link)) for i, p in enumerate(parts)]
    rows += [(100, "http://a100.org/", "<meta http-equiv=refresh content=\"" + " " * 3_000_000 + "x"), (101, "http://x.net/fr/1", None)]
    t = time.time()
    got = {r.page_id: r.verdict for r in url_filter(pages(rows)).collect()}
    assert time.time() - t < 60
    assert {i for i, v in got.items() if v == "block"} == {*range(len(parts)), 101}
