from __future__ import annotations

import pytest

from ontime.llm import url_filters

CASES = [
    ("https://Blog.EXAMPLE.org/es/1?x", "blog.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/177#a", "example.org", "/en/177", "example.org/en/1", "block"),
    ("http://example.org/en/277", "example.org", "/en/277", "org/", "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://a.com/de/", "a.com", "/de/", "com/de/", "block"),
    ("http://a.com/fr/2", "a.com", "/fr/2", "com/fr/", "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("http://org", "org", "", None, "allow"),
    ("http://a.org:80/x", "a.org:80", "/x", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://" + "a." * 300 + "org/" + "p" * 5000, "a." * 300 + "org", "/" + "p" * 5000, "org/", "allow"),
    ("a://b.com/de/c://d", "b.com", "/de/c://d", "com/de/", "block"),
]


def pages(spark, urls):
    rows = [(i, u, "clash", "clash", None) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, suffix string, digest string, length int")


def test_cases(spark):
    urls = [case[0] for case in CASES] * 2
    rules = url_filters.rule_table(spark, url_filters.RULES)
    rows = url_filters.judge_urls(pages(spark, urls), rules).collect()
    assert len(rows) == len(urls)
    for row in rows:
        assert (row.url, row.host, row.path, row.rule, row.verdict) == CASES[row.page_id % len(CASES)]


def test_ties_go_to_the_longer_host_then_to_block(spark):
    rules = [("allow", "org", "/ab"), ("block", "a.org", "/"), ("allow", "a.org", "/")]
    table = url_filters.rule_table(spark, rules)
    (row,) = url_filters.judge_urls(pages(spark, ["http://a.org/ab"]), table).collect()
    assert (row.rule, row.verdict) == ("a.org/", "block")


def test_rules_that_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "broadcast_if_small", lambda df, rows: df.hint("merge"))
    test_cases(spark)


def test_very_long_urls(spark):
    path = "/en/1" + "/x" * 150_000
    urls = [f"http://{'sub.' * 2000}example.org{path}?{'q' * 100_000}", "http://" + "h" * 300_000]
    rules = url_filters.rule_table(spark, url_filters.RULES)
    found = {r.page_id: r for r in url_filters.judge_urls(pages(spark, urls), rules).collect()}
    assert (found[0].rule, found[0].verdict, found[0].path) == ("example.org/en/1", "block", path)
    assert (found[1].host, found[1].rule, found[1].verdict) == ("h" * 300_000, None, "allow")


@pytest.mark.parametrize("empty", ["pages", "rules"])
def test_empty_tables(spark, empty):
    rules = url_filters.rule_table(spark, url_filters.RULES)
    urls = pages(spark, ["http://a.org/"])
    if empty == "pages":
        assert url_filters.judge_urls(urls.where("false"), rules).collect() == []
    else:
        (row,) = url_filters.judge_urls(urls, rules.where("false")).collect()
        assert (row.rule, row.verdict) == (None, "allow")
