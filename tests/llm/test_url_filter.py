"""URL rules and host reputation on odd URLs."""

from searchmill.llm.url_filter import filter_urls, host_levels, host_reputation

SCHEMA = "page_id long, url string, host int, verdict string"
ROWS = [
    (1, "http://A.Example.ORG/es/1?x=/en/1", 1, None),
    (2, "https://example.org/en/12", 1, None),
    (3, "https://notexample.org/en/12", None, None),
    (4, "https://x.com/fr/", None, None),
    (5, "ftp://x.com/de/#://y", None, None),
    (6, "https://x.com/de", None, None),
    (7, "no scheme", None, None),
    (8, None, None, None),
    (9, "", None, None),
    (10, "https://x.org?q=/es/", None, None),
    (11, "https://x.org", None, None),
    (11, "https://x.org", None, None),
    (12, "http://a\nb/c\nd?e", None, None),
]
WANT = {
    1: ("a.example.org", "/es/1", "example.org/es/", "block"),
    2: ("example.org", "/en/12", "example.org/en/1", "block"),
    3: ("notexample.org", "/en/12", "org/", "allow"),
    4: ("x.com", "/fr/", "com/fr/", "allow"),
    5: ("x.com", "/de/", "com/de/", "block"),
    6: ("x.com", "/de", None, None),
    7: ("", "", None, None),
    8: ("", "", None, None),
    9: ("", "", None, None),
    10: ("x.org", "", None, None),
    11: ("x.org", "", None, None),
    12: ("a\nb", "/c\nd", None, None),
}


def test_rules(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    outcomes = spark.createDataFrame([(6, 0), (6, None), (None, 1)], "page_id long, good int")
    rows = filter_urls(pages, outcomes).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        host, path, rule, verdict = WANT[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict or verdict is None and r.verdict in ("allow", "block")


def test_no_labels_and_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, good int")
    pages = spark.createDataFrame(ROWS, SCHEMA)
    assert {r.mean for r in host_reputation(pages, none).collect()} == {0.5}
    assert filter_urls(pages.limit(0), none).collect() == []


def test_shrinkage(spark):
    """A host moves from its domain's rate towards its own as its labels grow."""
    rows, labels = [], []
    for host, good, bad in [("a.x.org", 90, 10), ("b.x.org", 5, 95), ("c.x.org", 0, 1), ("q.y.com", 50, 50)]:
        for k in range(good + bad):
            rows.append((len(rows), f"http://{host}/{k}", None, None))
            labels.append((len(labels), int(k < good)))
    rows.append((10_000, "http://new.x.org/", None, None))
    pages = spark.createDataFrame(rows, SCHEMA)
    outcomes = spark.createDataFrame(labels, "page_id long, good int")
    by = {r.host: r for r in host_reputation(pages, outcomes).collect()}
    assert 0.8 < by["a.x.org"].mean < 0.9
    assert 0.05 < by["b.x.org"].mean < 0.15
    assert 0.2 < by["c.x.org"].mean < by["new.x.org"].mean < 0.55
    assert all(0 <= r.bound <= r.mean for r in by.values())
    verdicts = {r.host: r.verdict for r in filter_urls(pages, outcomes, rules=[]).collect()}
    assert (verdicts["a.x.org"], verdicts["b.x.org"]) == ("allow", "block")


def test_suffix_table(spark):
    """Longest suffix, wildcard, exception; without a fitting one the last two labels."""
    suffixes = [("co.uk",), ("uk",), ("com",), (".COM.au",), ("*.ck",), ("!www.ck",), ("co.uk",), (None,), ("",)]
    want = {
        "news.bbc.co.uk": ("bbc.co.uk", "co.uk"),
        "bbc.co.uk:8080": ("bbc.co.uk:8080", "co.uk:8080"),
        "co.uk": ("co.uk", "co.uk"),
        "a.b.uk": ("b.uk", "uk"),
        "notco.uk": ("notco.uk", "uk"),
        "x.com.au": ("x.com.au", "com.au"),
        "a.b.c.ck": ("b.c.ck", "c.ck"),
        "ck": ("ck", "ck"),
        "a.www.ck": ("www.ck", "ck"),
        "a.x.org": ("x.org", "org"),
        "": ("", ""),
    }
    hosts = spark.createDataFrame([(h, 1) for h in want], "host string, n int")
    for table, rows in (("none", []), ("some", suffixes)):
        given = spark.createDataFrame(rows, "suffix string")
        got = {r.host: (r.domain, r.suffix) for r in host_levels(hosts, given).collect()}
        plain = {r.host: (r.domain, r.suffix) for r in host_levels(hosts).collect()}
        assert got == (want if table == "some" else plain)


def test_unrelated_sites_of_a_long_suffix_do_not_share(spark):
    """A host without labels follows its own site, not another one under `co.uk`."""
    rows, labels = [], []
    for host, good in [("a.good.co.uk", 1), ("b.good.co.uk", 1), ("a.bad.co.uk", 0), ("b.bad.co.uk", 0)]:
        for k in range(100):
            rows.append((len(rows), f"http://{host}/{k}", None, None))
            labels.append((len(labels), good))
    rows += [(1000, "http://new.good.co.uk/", None, None), (1001, "http://new.bad.co.uk/", None, None)]
    pages = spark.createDataFrame(rows, SCHEMA)
    outcomes = spark.createDataFrame(labels, "page_id long, good int")
    suffixes = spark.createDataFrame([("co.uk",)], "suffix string")
    judged = filter_urls(pages, outcomes, rules=[], suffixes=suffixes).collect()
    verdicts = {r.host: r.verdict for r in judged}
    assert len(judged) == len(rows)
    assert (verdicts["new.good.co.uk"], verdicts["new.bad.co.uk"]) == ("allow", "block")


def test_pages_are_joined_once(spark):
    """What the levels need is one row per host, written once."""
    pages = spark.createDataFrame([(k, f"https://h{k % 9}.example.com/x") for k in range(60)], "page_id long, url string")
    outcomes = spark.createDataFrame([(k, k % 2) for k in range(60)], "page_id long, good int")
    judged = host_reputation(pages, outcomes)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "url" not in plan and judged.count() == 9
