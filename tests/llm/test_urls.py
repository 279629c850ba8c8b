"""URL verdicts against plain Python, on odd URLs, any filter size, and empty tables."""

import re

import pytest

from evenkeel.llm import urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
URLS = [
    None, "", "no scheme", "http://", "HTTPS://WWW.Example.NET/a/?utm_source=x&b=2&a=1#top", "http://example.net/a?a=1&b=2", "https://example.net:443/a//?a=1&b=2&ref=q",
    "http://example.net:8080/a?a=1&b=2", "http://sub.example.org/es/1", "http://example.org/es", "http://example.org/en/12?x", "http://org/", "http://org", "http://xorg/",
    "http://a.com/fr/1", "http://a.com/de/1", "http://a.com?/fr/", "a://b://c/d", "http://É.net/Ü\n?q", "ftp://x.net/a", "http://x.net/a#f?ref=1", "http://x.net/?ref", "http://x.net/?&&", "http://x.net", "http://x.net\n", "http://x.net/\n", "http://x.net/?ref\n",
]
TRACKING = urls.TRACKING.replace(r"\z", r"\Z")
LISTED = ["https://example.net/a?b=2&a=1", "http://www.x.net/", "http://a.com/de/1", "http://sub.example.org/es/1", None, "nothing", "ftp://x.net/a"]


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)(?:\?([^#]*))?", url or "")
    if not m:
        return "", "", None
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1])
    name = re.sub(r"\.?(:(80|443)?)?\Z", "", re.sub(r"^www\.", "", host))
    asked = sorted(x for x in (m[3] or "").split("&") if x and not re.search(TRACKING, x))
    return host, m[2], (name + m[2].rstrip("/") + ("?" + "&".join(asked) if asked else "")) if name else None


def brute(urls_in, listed):
    forms = {parts(u)[2] for u in listed} - {None}
    for u in urls_in:
        host, path, form = parts(u)
        fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "block" if form in forms else "allow"))
        yield host, path, rule, verdict


@pytest.mark.parametrize("most", [1, 1 << 20])
@pytest.mark.parametrize("listed", [LISTED, []])
def test_equal_to_plain_python(spark, most, listed):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS * 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, __key string")
    found = urls.judge_urls(pages, spark.createDataFrame([(u,) for u in listed], "url string"), RULES, most_blocks=most)
    assert found.columns == ["page_id", "url", "__key", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert [got[i] for i in range(len(rows))] == list(brute(URLS * 3, listed))


def test_filter_passes_all_that_is_listed_and_little_else(spark):
    keys = spark.range(20000).selectExpr("concat('a/', id) as k")
    blocks = urls.blocks_for(20000)
    table = urls.bloom_filter(keys, "k", blocks)
    assert table.count() <= blocks
    probe = spark.range(40000).selectExpr("id", "concat('a/', id) as k")
    block, bits = urls._bits(probe.k, blocks)
    passed = probe.join(table, block == table.block)
    for i, b in enumerate(bits):
        passed = passed.where(table[f"w{i}"].bitwiseAND(b) != 0)
    ids = {r.id for r in passed.select("id").collect()}
    assert set(range(20000)) <= ids and len(ids) < 21000


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(none, none, RULES).collect() == []


def test_pages_stay_in_their_tasks(spark):
    """Only what passes the filter is shuffled."""
    pages = spark.range(1000).selectExpr("id as page_id", "concat('http://a.net/', id) as url")
    plan = urls.judge_urls(pages, pages.where("page_id < 10"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "Python" not in plan
