import re

from tests.conftest import rows
from tidemark.llm import url_filter

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def page(spark, data):
    filled = [(i, u, h, "old", "old", i) for i, (u, h) in enumerate(data)]
    return spark.createDataFrame(filled, "page_id long, url string, html string, verdict string, host string, key int")


def judged(spark, data, rules=RULES):
    out = url_filter.judge(page(spark, data), url_filter.rule_table(spark, rules))
    return {r.page_id: r for r in out.collect()}


def by_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *((max(fits)[2], max(fits)[1]) if fits else (None, "allow"))


def test_rules_match_by_suffix_and_prefix(spark):
    urls = ["http://A.Example.NET/en/x", "http://example.net/de", "http://notexample.net/en/", "http://example.com/de/1?q#f", "http://x.org/fr/",
            "http://org/fr/a", "ftp://sub.example.com/en", "http://example.net", "http://example.net?x=/en/", "no scheme", "", None, "://", "http:///p",
            "http://example.net#/en/", "http://a.b.c.d.e.example.com/de/", "x://y://z.net/", "http://ÀB.NET/", "http://example.net:80/en/"]
    got = judged(spark, [(u, None) for u in urls])
    for i, url in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == by_rule(url), url


def test_blocks_reach_aliases_unless_a_member_is_allowed(spark):
    link = '<LINK href="{}" rel=canonical>'.format
    data = [
        ("http://plain.com/a", link("http://bad.net/x")),  # its canonical form is blocked
        ("http://plain.com/b", '<meta http-equiv="refresh" content="0; URL=/a">'),  # redirects to an alias of it
        ("http://other.com/c", link("http://bad.net/y")), ("http://other.com/c", link("//good.org/fr/1")),  # one member is allowed
        ("http://example.net/en/k", link("http://bad.net/x")),  # allowed by its own rule, and so allows its component
        ("http://far.com/d", link("#top") + link("") + link("?p=1&amp;q=2")), ("http://far.com/d?p=1&q=2", None), ("http://none.com/", ""), (None, link("/x")),
    ]
    got = judged(spark, data)
    assert [(got[i].verdict, got[i].reason) for i in range(len(data))] == [
        ("allow", "alias"), ("allow", "alias"), ("allow", "alias"), ("allow", "alias"), ("allow", "rule"), ("allow", "default"), ("allow", "default"),
        ("allow", "default"), ("allow", "default")]
    got = judged(spark, data[:2])
    assert [(got[i].verdict, got[i].reason) for i in range(2)] == [("block", "alias"), ("block", "alias")]


def test_many_rules_a_chain_of_redirects_and_repeated_rows(spark):
    rules = [("block", f"h{i}.com", f"/p{j}") for i in range(40) for j in range(5)] + [("allow", "h1.com", "/p1"), ("block", None, "/")]
    chain = [(f"http://c.com/{i}", f'<link rel="canonical" href="http://c.com/{i + 1}">') for i in range(12)]
    chain[-1] = (chain[-1][0], '<link rel="canonical" href="http://h7.com/p3/z">')
    got = judged(spark, chain + chain[:3] + [("http://h1.com/p1", None), ("http://h1.com/p2x", None)], rules)
    assert [got[i].verdict for i in range(15)] == ["block"] * 15
    assert (got[15].verdict, got[16].verdict) == ("allow", "block")


def test_clashing_columns_stay(spark):
    from pyspark.sql import functions as F
    from tests.llm.messy import EXTRAS

    data = page(spark, [("http://a.net/", ""), ("http://b.org/fr/x", ""), (None, None)]).withColumns({c: F.lit(i) for i, c in enumerate(EXTRAS)})
    got = url_filter.judge(data, url_filter.rule_table(spark, RULES)).collect()
    assert len(got) == 3 and all(r[c] == i for r in got for i, c in enumerate(EXTRAS) if c not in ("host", "path", "rule", "verdict", "reason"))


def test_empty_tables(spark):
    empty = page(spark, [("http://a.net/", "")]).limit(0)
    assert rows(url_filter.judge(empty, url_filter.rule_table(spark, RULES))) == []
    none = url_filter.rule_table(spark, RULES).limit(0)
    assert [r.verdict for r in url_filter.judge(page(spark, [("http://a.net/", "")]), none).collect()] == ["allow"]
