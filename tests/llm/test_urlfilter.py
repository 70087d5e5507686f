"""URL rules against plain Python, and what the model does on the hosts of the pages."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from listingguard.llm import queries, urlfilter
from listingguard.llm.urlfilter import ALLOW, BLOCK, Rule


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut].translate({i: i + 32 for i in range(65, 91)}), rest[cut:]
    return host, rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]


def rule_of(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), r.verdict == BLOCK), default=None)


URLS = [
    None, "", "no scheme", "://", "http://", "http:///en/", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com", "http://example.com?x=/en/",
    "http://example.com/en/", "http://example.com/en", "http://badexample.com/en/1", "http://a.b.example.com/en/1#://q.net/es/", "ftp://x.net/es/1",
    "http://x.net/ES/1", "http://net/fr/", "http://a://b.net/fr/", "http://É.NET/fr/é\n/x", "http://x.org#a", "//x.net/es/", "http://user@x.net:80/es/",
    "http://www.example.com/en/", "http://x.www.example.com/en/a", "http://x.net/es/" + "a" * 20_000, "http://casino-bets.example.org/x", "http://x.com\n.net/es/",
]


def test_against_plain_rules(spark):
    rows = [(i, u, "old", 1) for i, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame([*rows, (None, URLS[9], "old", 1)], "page_id long, url string, verdict string, extra int").repartition(3)
    model = urlfilter.fit(urlfilter.labelled_urls(spark))
    got = urlfilter.judge(pages, model).collect()
    assert len(got) == len(rows) + 1 and all(r.extra == 1 for r in got)
    for r in got:
        rule = rule_of(r.url, urlfilter.RULES)
        assert (r.host, r.path) == parts(r.url)
        assert r.rule == (rule.text if rule else None)
        assert r.verdict == (rule.verdict if rule else BLOCK if r.score >= 0.5 else ALLOW)
    assert len({r.score for r in got if r.url == URLS[9]}) == 1
    assert Counter(r.verdict for r in got if r.url == "http://casino-bets.example.org/x") == {BLOCK: 2}


def test_equal_rules_and_longest():
    rules = [Rule(ALLOW, "a.net", "/"), Rule(BLOCK, "a.net", "/"), Rule(ALLOW, "a.net", "/x"), Rule(BLOCK, "x.a.net", "/x/")]
    assert rule_of("http://a.net/", rules).verdict == BLOCK and rule_of("http://x.a.net/x/", rules).text == "x.a.net/x/"
    with pytest.raises(ValueError, match="at most"):
        urlfilter.matched([Rule(ALLOW, f"h{i}", "/") for i in range(1001)])


def test_rule_ties_in_spark(spark):
    rules = [Rule(BLOCK, "a.net", "/"), Rule(ALLOW, "a.net", "/"), Rule(ALLOW, "a.net", "/x"), Rule(BLOCK, "net", "/x/yz")]
    pages = spark.createDataFrame([("http://a.net/",), ("http://a.net/x",), ("http://a.net/x/yz",), ("http://b.net/",)], "url string")
    got = {r.url: (r.rule, r.verdict) for r in urlfilter.judge(pages, 0.0, rules).collect()}
    assert got == {
        "http://a.net/": ("a.net/", BLOCK), "http://a.net/x": ("a.net/x", ALLOW), "http://a.net/x/yz": ("net/x/yz", BLOCK), "http://b.net/": (None, ALLOW),
    }


def test_hosts_of_the_pages(spark):
    """The hosts are not in the labelled table; the words of the unwanted ones are."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    unwanted = F.regexp_extract("url", "://([^/?#]*)", 1).rlike(r"(^|\.)(casino-win|free-bets|cheap-pills|ads-track|spam-farm|adult-x)\.")
    got = urlfilter.scored(pages, urlfilter.fit(urlfilter.labelled_urls(spark))).groupBy(unwanted.alias("bad")).agg(F.avg((F.col("score") >= 0.5).cast("int")).alias("share"))
    share = {r.bad: r.share for r in got.collect()}
    assert share[True] >= 0.95 and share[False] <= 0.02


def test_labels_of_one_class_and_empty_tables(spark):
    labelled = urlfilter.labelled_urls(spark)
    pages = spark.createDataFrame([(1, "http://x.org/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urlfilter.judge(pages, urlfilter.fit(labelled.where("label = 1"))).collect()} == {BLOCK}
    assert {r.verdict for r in urlfilter.judge(pages, urlfilter.fit(labelled.limit(0))).collect()} == {ALLOW}
    assert urlfilter.judge(pages.limit(0), urlfilter.fit(labelled)).collect() == []


def test_query(spark, sf_dir):
    got = queries.op12_url_filters(spark, sf_dir)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert got.count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
