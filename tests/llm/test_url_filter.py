import re

import pytest

from trajspark.llm.url_filter import build_cascade, judge_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de", "block"), ("org", "", "allow"), ("a.b.org", "/x/y", "block")]
URLS = [
    "http://a.example.net/en/x", "https://EXAMPLE.net/fr", "http://example.net", "ftp://x.net/", "no scheme", "", None, "http://example.com/den?x=/de/",
    "http://notexample.com/de", "http://q.example.com/de/#a", "http://org/", "http://z.a.b.org/x/yz", "http://b.org?x", "x://y://net/", "http://net./",
    "http:///net/", "http://" + "l." * 300 + "net/" + "p/" * 2000, "http://a.example.net/en/x",
]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h.lower() + p, v) for h, p, v in RULES if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("bound", [16 << 20, 1], ids=["cascade", "beyond the bound"])
def test_rules(spark, bound):
    pages = spark.createDataFrame([(i, u, "rule", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, key int")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules, max_filter_bytes=bound).collect()}
    assert got == {i: judged(u) for i, u in enumerate(URLS)}
    assert judge_urls(pages.filter("false"), rules, max_filter_bytes=bound).count() == 0
    assert {r.verdict for r in judge_urls(pages, rules.filter("false"), default="block").collect()} == {"block"}


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20_000).selectExpr("concat('k', id) AS key", "id % 9 = 0 AS listed")
    cascade = build_cascade(keys.filter("listed").select("key"), keys.filter("not listed").select("key"))
    assert len(cascade.levels) > 1
    assert keys.filter(cascade.has(keys["key"]) != keys["listed"]).count() == 0
