"""Verdicts of the longest rule and of aliases; edge cases."""

from llm_fixtures import SF_SMALL
from pyspark.sql import functions as F

from critloom.llm import urls
from critloom.llm.queries import URL_RULES, op3_url_filters


def canonical(href):
    return f'<html><head><LINK href="{href}" rel="canonical"></head></html>'


def test_split_url():
    for url, want in ((None, ("", "")), ("no scheme/x", ("", "")), ("http://A.Com", ("a.com", "")), ("x://H/p/q?r#s", ("h", "/p/q")),
                      ("http://h?x=/y", ("h", "")), ("http://h#f/g", ("h", "")), ("http://ÄB.de/é", ("Äb.de", "/é")), ("", ("", ""))):
        assert urls.split_url(url) == want


def brute_rule(url):
    host, path = urls.split_url(url)
    fits = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda x: len(x[0])) if fits else (None, None)


def test_every_page_of_a_table(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = op3_url_filters(spark, SF_SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        rule, verdict = brute_rule(pages[r.page_id])
        assert (r.host, r.path) == urls.split_url(pages[r.page_id])
        assert (r.rule, r.verdict) == (rule, verdict or "allow")


def test_blocks_reach_aliases_and_allows_come_first(spark):
    rows = [(1, "http://a.org/1", canonical("http://x.net/es/1")),          # alias of a blocked address
            (2, "http://b.org/2", canonical("http://a.org/1#top")),          # alias of that alias
            (3, "http://c.org/3", '<meta http-equiv="Refresh" content="0; URL=\'https://b.org/2\'">'),
            (4, "http://d.org/4", canonical("http://x.net/es/9")),           # its component holds an allowed address
            (5, "http://shop.com/5", canonical("http://d.org/4")),
            (6, "http://y.net/fr/6", canonical("http://shop.com/5")),        # its own rule stays
            (7, "http://lone.org/", None), (8, None, "<link rel=canonical href=http://x.net/es/1>"), (9, "bad", ""),
            (10, "http://e.org/a/b", canonical("../c")), (11, "http://e.org/c", ""), (1, "http://a.org/1", canonical("http://x.net/es/1")),
            (None, "http://x.net/es/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("x")).withColumn("node", F.lit(1))
    got = [(r.page_id, r.verdict) for r in urls.judge(pages, URL_RULES).collect()]
    want = {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "allow", 8: "allow", 9: "allow", 10: "allow", 11: "allow", None: "block"}
    assert len(got) == len(rows) and all(want[i] == v for i, v in got)
    comp = {r.page_id: r.component for r in urls.judge(pages, URL_RULES).collect()}
    assert comp[1] == comp[2] == comp[3] == comp[None] != comp[4] == comp[5] == comp[6] and comp[10] == comp[11] and comp[7] is None


def test_redirect_table_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", None)], "page_id long, url string, html string")
    moved = spark.createDataFrame([("http://a.org/", "http://z.org/"), ("http://z.org/", "http://x.net/fr/"), (None, "http://q.org")], "from_url string, to_url string")
    assert urls.judge(pages, URL_RULES, redirects=moved).first().verdict == "block"
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0
    assert urls.judge(pages, []).first().verdict == "allow"


def test_alias_attributes_are_unescaped_and_may_hold_brackets():
    url = "http://a.org/p"
    assert urls.aliases(url, canonical("/q?a=1&amp;b=2")) == ["http://a.org/q?a=1&b=2"]
    assert urls.aliases(url, '<meta http-equiv="refresh" content="0; url=/q?a=1&amp;b=2">') == ["http://a.org/q?a=1&b=2"]
    assert urls.aliases(url, '<link title="a > b < c" rel="canonical" href="/q?x=1>0">') == ["http://a.org/q?x=1>0"]
    assert urls.aliases(url, "<link title='it > is' rel=canonical href=/q>") == ["http://a.org/q"]
    assert urls.aliases(url, '<link title=it\'s rel="canonical" href="/q">') == ["http://a.org/q"]
    assert urls.aliases(url, '<link b="x" ' + 'c="<link" ' * 50_000) == []  # linear


def test_long_broken_tags_take_linear_time():
    import time

    from critloom.llm import urls
    n = 1_000_000
    tags = ["<link " + "a" * n + ">", "<link " + " " * n + ">", "<link " + '"' * n + ">", "<link a" + " " * (n // 2) + "b" * (n // 2) + ">",
            "<link " + "a=" * (n // 2) + ">", "<link " + "=\"'" * (n // 3) + ">", "<meta " + "a='" * (n // 3), "<link " * (n // 6)]
    for tag in tags:
        began = time.perf_counter()
        assert urls.aliases("http://a.b/c", tag + '<link rel="canonical" href="/d">') in ([], ["http://a.b/d"])
        assert time.perf_counter() - began < 5
    assert urls.aliases("http://a.b/c", '<link data-x REL = "canonical" href\n=\n/e>') == ["http://a.b/e"]
