import re

import pytest

from datasheaf.llm import url_filters

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "a.b", "/x"), ("block", "a.b", "/x"), ("allow", "a.b", "/x")]
URLS = [
    "http://www.example.com/en/1", "https://blog.example.com/en/2?x#y", "http://EXAMPLE.com/en", "http://example.com", "http://x.net/es/", "http://notexample.com/en/", "http://net/es/a", None, "", "no scheme",
    "http://", "a://b://c.com/d", "http://x.com.:80/", "http://q.a.b/xyz", "http://a.b/x?y", "http://q.a.bb/xyz", "http://com/", "http://example.com/EN/", "ftp://ä.example.com/en/ü", "http://www.example.com/en/1",
]


def plain(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_against_plain(spark):
    pages = spark.createDataFrame([(i, u, "old") for i, u in enumerate(URLS)] + [(None, URLS[0], "old")], "page_id int, url string, host string")
    got = url_filters.judge_urls(pages, url_filters.rule_table(spark, RULES)).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, RULES), r


@pytest.mark.parametrize("rules", [[], [("block", "com", "")]])
def test_small_lists_and_no_rows(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.com")], "page_id int, url string")
    table = url_filters.rule_table(spark, rules) if rules else spark.createDataFrame([], "verdict string, host string, path string")
    assert url_filters.judge_urls(pages, table).first().verdict == ("block" if rules else "allow")
    assert url_filters.judge_urls(pages.limit(0), table).count() == 0
