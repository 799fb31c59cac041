import re
from collections import Counter

import pytest

import __spark_entry__ as E
from tessera.compare import compare, duck
from tessera.llm import urls
from tessera.llm.queries import URL_RULES
from tests.llm.conftest import SF


def slow_canonical(url):
    if url is None or "://" not in url:
        return None
    host, path, query = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)\??([^#]*)", url).groups()
    host = re.sub(r"^www\.", "", re.sub(":(80|443)$", "", re.sub("[A-Z]", lambda m: m[0].lower(), host)))
    query = "&".join(sorted(p for p in query.split("&") if p and not p.startswith("utm_")))
    return host + path.rstrip("/") + ("?" + query if query else "")


AWKWARD = [
    (1, "https://WWW.Example.org:443/a/?b=2&utm_x=1&a=1#f"),
    (2, "http://example.org/a?a=1&b=2"),
    (3, None),
    (4, ""),
    (5, "no scheme/org"),
    (6, "x://"),
    (7, "http://org/en"),
    (8, "http://sub.example.org/en/12"),
    (9, "http://notexample.org/en/12"),
    (10, "http://example.com/de/" + "x" * 100_000),
    (None, "http://example.net/q"),
    (12, "http://example.net/q#top"),
    (12, "http://example.net/q#top"),
    (13, "HTTP://EXAMPLE.NET:80/Q"),
    (14, "a://b://org/x"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in AWKWARD], "page_id long, url string, host string, block string")


def test_matches_sql(spark):
    res = compare(E.queries()["op7_urls"](spark, SF), duck(SF), E.oracle_sql()["op7_urls"])
    assert res["values_match"], res


def test_list_is_exact_at_any_filter_size(spark, pages):
    listed = spark.createDataFrame([("http://example.org/a/?b=2&a=1",), ("https://www.example.net/q",), (None,), ("junk",)], "url string")
    keys = {slow_canonical(r.url) for r in listed.collect()} - {None}
    want = Counter((i, "block" if slow_canonical(u) in keys else "allow") for i, u in AWKWARD)
    for blocks in (1, 1 << 10):
        got = urls.filter_urls(pages, listed, (), max_blocks=blocks)
        assert Counter((r.page_id, r.verdict) for r in got.collect()) == want
    assert want[12, "block"] == 2 and want[1, "block"] == 1


def test_rules(spark, pages):
    none = spark.createDataFrame([], "url string")
    got = {r.page_id: (r.host, r.path[:9], r.rule, r.verdict) for r in urls.filter_urls(pages, none, URL_RULES).collect()}
    assert got[3] == got[4] == got[5] == ("", "", None, "allow")
    assert got[7] == ("org", "/en", "org/", "allow")
    assert got[8] == ("sub.example.org", "/en/12", "example.org/en/1", "block")
    assert got[9] == ("notexample.org", "/en/12", "org/", "allow")
    assert got[10] == ("example.com", "/de/xxxxx", "com/de/", "block")
    assert got[14][0] == "b:" and got[13][:2] == ("example.net:80", "/Q")


def test_empty_tables(spark, pages):
    assert urls.filter_urls(pages.limit(0), pages.select("url")).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages, pages.select("url").limit(0)).collect()} == {"allow"}


def test_no_python_in_the_plan(spark):
    plan = E.queries()["op7_urls"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "BroadcastHashJoin" in plan
