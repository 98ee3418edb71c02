from shredline.llm import url_filter
from tests.compare import assert_same


def test_matches_sql(spark, sf):
    assert_same(url_filter.op5_url_filter(spark, sf), url_filter.ORACLE, sf)


CASES = [
    (1, None, "", "", None, "allow"), (2, "no scheme", "", "", None, "allow"), (3, "://", "", "", None, "allow"),
    (4, "http://EXAMPLE.Net/en/x?q#f", "example.net", "/en/x", "example.net/en/", "allow"), (5, "http://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    (6, "http://a.b.example.com/de/", "a.b.example.com", "/de/", "example.com/de/", "block"), (7, "http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    (8, "http://x.net", "x.net", "", None, "allow"), (9, "http://x.net?a=/", "x.net", "", None, "allow"), (10, "http://x.net#/", "x.net", "", None, "allow"),
    (11, "http://net/a", "net", "/a", "net/", "block"), (12, "http://é.org/fr/é", "é.org", "/fr/é", "org/fr/", "allow"), (12, "http://é.org/fr/é", "é.org", "/fr/é", "org/fr/", "allow"),
    (None, "ftp://u:p@h.net:80/x://y", "u:p@h.net:80", "/x://y", None, "allow"), (13, "http://" + "a." * 3000 + "net/", "a." * 3000 + "net", "/", "net/", "block"), (14, "", "", "", None, "allow"),
]


def test_cases(spark):
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(c[0], c[1], "html", "clash", "clash") for c in CASES], "page_id long, url string, html string, host string, rule string")
    got = [tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in url_filter.judge_urls(pages, rules).collect()]
    assert sorted(got, key=str) == sorted(((i, h, p, r, v) for i, _, h, p, r, v in CASES), key=str)
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.where("false"), "block").collect()} == {"block"}
    assert url_filter.judge_urls(pages.where("false"), rules).count() == 0


def test_ties(spark):
    rules = spark.createDataFrame([("b.net", "/x", "allow"), ("net", "/xyz", "block"), ("net", "/xyz", "allow")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b.net/xyz"), (2, "http://c.net/xyz")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {1: ("b.net/x", "allow"), 2: ("net/xyz", "block")}
