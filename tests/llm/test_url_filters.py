"""URL filters against a plain version, on awkward URLs and large rule lists."""

import random

from pyspark.sql import functions as F

from forumtide.llm import url_filters
from forumtide.llm.url_filters import ALLOW, BLOCK

SCHEMA = "page_id bigint, url string, html string, host string, path string, rule int, labels int"


def _frame(spark, urls):
    return spark.createDataFrame(
        [(i, url, "h", "x", "y", 1, 2) for i, url in urls], SCHEMA
    )


def _plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, after = rest[:cut], rest[cut:]
    end = min((after.index(c) for c in "?#" if c in after), default=len(after))
    lower = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
    return host.translate(lower), after[:end]


def _plain(url, rules):
    host, path = _plain_parts(url)
    fitting = [
        (len(h) + len(p), len(h), action, h + p) for action, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=None)
    return host, path, best and best[3], best[2] if best else ALLOW


def _check(spark, urls, rules):
    table = url_filters.rule_table(spark, rules)
    got = url_filters.judged(_frame(spark, urls), table).collect()
    expected = [(i, *_plain(url, rules)) for i, url in urls]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    return {r["page_id"]: r for r in got}


AWKWARD = [
    (1, None), (2, ""), (3, "no scheme/net/"), (4, "http://NET/"), (5, "http://net"),
    (6, "https://a.b.Example.NET/en/x?q=/de/"), (7, "https://example.net/en"),
    (8, "https://badexample.net/en/"), (9, "https://example.com/de/a#b"),
    (10, "https://example.com/fr/"), (11, "http://x.org/fr/"), (12, "http://x.org/fr"),
    (13, "http://net:80/"), (14, "http://.net/"), (15, "http://net./"), (16, "ftp://?q"),
    (17, "a://b://c.net/"), (18, "http://ÄB.net/é"), (19, "http://example.net//en/"),
    (20, "http://" + "a." * 50_000 + "net/" + "x/" * 50_000), (None, "http://q.net/"),
    (4, "http://NET/"), (21, "http://u@net/#"), (22, "http://line\nbreak.net/a\nb"),
]


def test_awkward_urls(spark):
    rows = _check(spark, AWKWARD, url_filters.RULES)
    assert rows[4]["verdict"] == BLOCK and rows[5]["rule"] is None
    assert rows[6]["rule"] == "example.net/en/" and rows[8]["rule"] == "net/"
    assert rows[13]["host"] == "net:80" and rows[13]["verdict"] == ALLOW


def test_empty_tables_and_rules(spark):
    none = _frame(spark, AWKWARD).limit(0)
    assert url_filters.judged(none, url_filters.rule_table(spark)).count() == 0
    _check(spark, AWKWARD, [])


def test_many_rules_of_all_shapes(spark):
    rng = random.Random(13)
    labels = ["a", "b", "net", "com", "x1"]
    def host():
        return ".".join(rng.choices(labels, k=rng.randint(1, 4)))

    def path():
        return "/" + "".join(rng.choices(["a", "b/", "/", "cc"], k=rng.randint(0, 4)))

    rules = [(rng.choice((ALLOW, BLOCK)), host(), path()) for _ in range(300)]
    urls = [(i, f"http://{host()}{path()}{path()}") for i in range(1500)]
    # One host has a third of the pages.
    urls += [(5000 + i, f"http://a.net/b/{i}") for i in range(700)]
    _check(spark, urls, rules)


def test_short_prefixes_are_confirmed_by_full_digests(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "SHORT", 1)
    rows = _check(spark, AWKWARD, url_filters.RULES)
    assert rows[10]["rule"] is None


def test_heads_are_judged_once_without_python(spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://w.net/a/"), "id").alias("url")
    )
    plan = url_filters.judged(pages, url_filters.rule_table(spark))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "NestedLoop" not in text
    assert plan.where("verdict = 'block'").count() == 3000
