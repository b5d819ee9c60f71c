import re

import pytest

from reuselens.llm import url_filter as U
from reuselens.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "http://com", "http://com/", "http://a.COM/x", "https://example.com/en/",
        "https://WWW.example.com/en/1?q#f", "https://m.www.example.com/en/1", "https://x.example.com/en/1",
        "https://notexample.com/en/1", "https://example.com/EN/1", "ftp://b.net/es/1", "ftp://b.net/es", "ftp://b.net/fr/?a",
        "https://example.com?x=/en/", "https://example.com#://b.net/es/", "//b.net/es/", "s://É.com/é", "s://u@com:80/",
        "https://com.net/es/", "a://..com/", "https://example.com/en/"]


def judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(-len(h + p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits, default=(0, None, default))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("small", [True, False])
def test_verdicts(spark, small, monkeypatch):
    """Also when list and filter are joined by shuffle."""
    if not small:
        monkeypatch.setattr(U, "BROADCAST_ROWS", 0)
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    extra = [("net", "/e", "allow"), ("x.example.com", "/en/1", "allow"), ("com", "", "block")]
    for rules in (URL_RULES, URL_RULES + extra):
        listed = spark.createDataFrame(rules, "host string, path string, verdict string")
        got = {r["page_id"]: tuple(r)[1:] for r in U.filter_urls(pages, listed).collect()}
        assert got == {i: judge(u, rules) for i, u in enumerate(URLS)}


def test_filter_has_no_false_negative(spark):
    keys = spark.range(5000).selectExpr("concat('h', id, '.org/') AS key")
    others = spark.range(5000, 45000).selectExpr("concat('h', id, '.org/') AS key")
    n = -(-5000 * U.BITS_PER_KEY // 512)
    blocks = U.bloom_blocks(keys, n)
    assert blocks.count() <= n
    assert U.passes(keys, blocks, n, True).count() == 5000
    assert U.passes(others, blocks, n, False).count() < 40000 * 0.02


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in U.filter_urls(pages, none, "block").collect()] == [(1, "a.com", "/", None, "block")]
    rules = spark.createDataFrame(URL_RULES + [("com", "/", "block"), (None, "/", "block")], "host string, path string, verdict string")
    assert U.filter_urls(pages, rules).collect()[0]["verdict"] == "block"
    assert U.filter_urls(pages.where("page_id = 0"), rules).count() == 0
