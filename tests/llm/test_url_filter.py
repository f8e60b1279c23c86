from helpers import rows
from monthplan.llm import url_filter as uf

PAGES = "page_id long, url string, HOST string, rule string"


def test_edges_and_longest_rule(spark):
    urls = [(1, "http://A.example.NET/en/x?y"), (2, "http://a.example.net/de/"), (3, "http://a.example.net"), (4, None), (5, ""),
            (6, "no scheme/net/"), (7, "x://b.org/fr/1#z"), (8, "http://notexample.net/en/"), (9, "http://net/"), (9, "http://net/"),
            (None, "http://m.example.com/de/1"), (11, "http://example.com/DE/1"), (12, "http://x.net?/en/"), (13, "a://b\nc.net/d\ne")]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in urls], PAGES)
    rules = spark.createDataFrame(list(uf.RULES), "action string, host string, path string")
    got = rows(uf.judge_urls(pages, rules), "page_id", "host", "path", "rule", "verdict")
    want = [(1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "a.example.net", "/de/", "net/", "block"),
            (3, "a.example.net", "", None, "allow"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
            (6, "", "", None, "allow"), (7, "b.org", "/fr/1", "org/fr/", "allow"), (8, "notexample.net", "/en/", "net/", "block"),
            (9, "net", "/", "net/", "block"), (9, "net", "/", "net/", "block"),
            (11, "example.com", "/DE/1", None, "allow"), (12, "x.net", "", None, "allow"),
            (13, "b\nc.net", "/d\ne", "net/", "block"), (None, "m.example.com", "/de/1", "example.com/de/", "block")]
    assert got == want


def test_the_bloom_filter_never_misses_and_mostly_stops(spark):
    keys = spark.range(5000).selectExpr("concat('h', id, '\n/') AS key")
    others = spark.range(20000).selectExpr("concat('o', id, '\n/') AS key")
    assert uf.possible_hits(keys, keys, 5000).count() == 5000
    assert uf.possible_hits(others, keys, 5000).count() < 400


def test_empty_tables(spark):
    pages = spark.createDataFrame([], PAGES)
    rules = spark.createDataFrame([], "action string, host string, path string")
    some = spark.createDataFrame([(1, "http://a.net/", "h", "r")], PAGES)
    assert uf.judge_urls(pages, spark.createDataFrame(list(uf.RULES), rules.schema)).count() == 0
    assert rows(uf.judge_urls(some, rules), "page_id", "rule", "verdict") == [(1, None, "allow")]
