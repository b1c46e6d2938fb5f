from __future__ import annotations

import re

from peerbench.llm.urls import RULES, filter_urls, mine_rules, tokens_of
from pyspark.sql import functions as F

URLS = [
    "https://www.Example.NET/en/1", "http://example.net/en", "http://net/", "http://net", "http://internet/en/", "https://a.b.org/fr/x?y#z", "https://org/FR/x",
    "http://example.com/de/", "ftp://x.example.com/de?x=/de/", "http://EXAMPLE.com:80/de/", "no scheme", "", None, "://", "a://b://c/en/", "HTTP://x.net?q", "http://x.net#/en/", "http://É.example.net/en/é",
    "http://ok.com/" + "p/" * 5000, "http://a\nb.net/\nq",
]


def given(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_given_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(1, URLS[1]), (None, URLS[0])], "page_id long, url string")
    nothing = spark.createDataFrame([], "url string, bad boolean")
    got = filter_urls(pages, nothing, ["page_id", "url"]).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = given(r["page"]["url"])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")


def test_mined_rules_block_and_are_pruned(spark):
    rows = [(f"http://h{i % 7}.com/a/{i}", i % 50 == 1) for i in range(200)] + [(f"http://spam.com/win/{i}?ref=x", i % 10 != 0) for i in range(60)]
    rows += [(f"http://fine.com/win/{i}", False) for i in range(80)] + [(None, True), ("http://h1.com/a/1", None)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    rules = {tuple(r["tokens"]): r for r in mine_rules(labelled, 0.01, 0.6).collect()}
    assert ("h:spam",) in rules and abs(rules["h:spam",]["confidence"] - 0.9) < 1e-9 and abs(rules["h:spam",]["support"] - 54 / 340) < 1e-9
    assert not any(len(t) > 1 and "h:spam" in t and rules[t]["confidence"] <= 0.9 for t in rules)
    pages = spark.createDataFrame([(1, "http://spam.com/new"), (2, "http://fine.com/win/9"), (3, "http://h2.com/a/3"), (4, None)], "page_id long, url string")
    got = {r["page"]["page_id"]: (r["verdict"], r["rule"]) for r in filter_urls(pages, labelled, min_support=0.01).collect()}
    assert got == {1: ("block", None), 2: ("allow", None), 3: ("allow", None), 4: ("allow", None)}


def test_tokens_empty_table_and_clashing_names(spark):
    one = spark.createDataFrame([("http://A.b.com/x12/y.html?q=1&r=&q=2#f",), (None,), ("x",)], "url string").select(tokens_of(F.col("url")).alias("t")).collect()
    assert [sorted(r["t"]) for r in one] == [sorted(["s:http", "h:a", "h:b", "h:com", "p:x0", "p:y", "p:html", "q:q", "q:r"]), [], []]
    nothing = spark.createDataFrame([], "url string, bad boolean")
    assert filter_urls(spark.createDataFrame([], "page_id long, url string"), nothing).count() == 0
    odd = spark.createDataFrame([(1, "http://net/", 7, "p")], "page_id long, url string, host int, verdict string")
    row = filter_urls(odd, nothing, odd.columns).first()
    assert row["page"]["host"] == 7 and row["host"] == "net" and row["verdict"] == "block"
