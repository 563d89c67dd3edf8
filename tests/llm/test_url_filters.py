import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest

from hazeframe.llm import url_filters
from hazeframe.llm.url_filters import dated_captures, dated_list, evaluate, intervals

START = date(2024, 1, 1)
ENTRIES = "level string, key string, listed_on date, action string"


def keys(url):
    """Keys of a URL, the most specific first."""
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^?#]*)", url or "")
    host = m[1].lower().rstrip(".") if m else ""
    if not host:
        return []
    steps, labels = [p for p in m[2].split("/") if p], host.split(".")
    out = [("path", "/".join([host, *steps[:n]])) for n in range(len(steps), 0, -1)]
    return [*out, ("host", host), *[("domain", ".".join(labels[n:])) for n in range(len(labels))]]


def expected(captures, entries):
    out = []
    for k, url, day in captures:
        verdict = ("unlisted", None, None)
        for level, key in keys(url):
            active = [(on, act == "block") for lv, ky, on, act in entries if (lv, ky) == (level, key) and act in ("block", "allow") and on and day and on <= day]
            if active:
                on, blocks = max(active)
                verdict = ("blocked" if blocks else "allowed", key, on)
                break
        out.append((k, verdict))
    return Counter(out)


def check(spark, captures, entries):
    df = spark.createDataFrame(captures, "page_id long, url string, fetched_on date")
    df = df.selectExpr("*", "1 AS key", "2 AS period", "3 AS row", "4 AS level", "5 AS shares", "6 AS host", "7 AS best")
    got = evaluate(df, spark.createDataFrame(entries, ENTRIES)).collect()
    assert Counter((r["page_id"], (r["verdict"], r["matched_key"], r["listed_on"])) for r in got) == expected(captures, entries)
    assert all(r["kept"] == (r["verdict"] != "blocked") for r in got)


URLS = [
    "http://a.b.com/x/1", "https://A.B.com:8080/y?q", "http://b.com", "http://u:p@c.b.com/x#t", "ftp://d.org/", "bad", None, "http:///x", "http://d.org/x/y/z", "http://localhost/q",
    "http://news.bbc.co.uk/a//b/c/", "http://bbc.co.uk./a", "http://x.y.a.b.com", "http://.../x", "http://e.org/" + "s/" * 3000,
]
LISTED = [
    ("domain", "b.com"), ("host", "a.b.com"), ("path", "a.b.com/x"), ("host", "d.org"), ("path", "d.org/x"), ("domain", "d.org"), ("host", "localhost"), ("host", "c.b.com"),
    ("domain", "co.uk"), ("domain", "bbc.co.uk"), ("path", "news.bbc.co.uk/a/b"), ("path", "d.org/x/y/z"), ("domain", "a.b.com"), ("domain", "com"), ("domain", "localhost"),
    ("path", "e.org" + "/s" * 2000),
]


def test_equals_brute_force(spark):
    rng = random.Random(3)
    day = lambda: START + timedelta(rng.randrange(400))
    captures = [(k, rng.choice(URLS), day() if rng.random() < 0.95 else None) for k in range(600)]
    captures += captures[:5]
    entries = [(*rng.choice(LISTED), day(), rng.choice(["block", "allow", "allow", "other"])) for _ in range(120)]
    entries += [("host", None, START, "block"), ("host", "d.org", None, "block"), ("other", "d.org", START, "block"), entries[0]]
    check(spark, captures, entries)


@pytest.mark.parametrize("hot", [1, 3, 10**6])
def test_hot_keys_are_dealt(spark, monkeypatch, hot):
    monkeypatch.setattr(url_filters, "HOT", hot)
    captures = [(k, "http://a.b.com/x/" + str(k % 7 if k % 3 else 0), START + timedelta(k % 5)) for k in range(300)]
    entries = [("domain", "b.com", START, "block"), ("path", "a.b.com/x/0", START + timedelta(2), "allow"), ("path", "a.b.com/x/0", START + timedelta(4), "block")]
    check(spark, captures, entries)


def test_the_whole_name_and_every_parent_can_be_listed(spark):
    captures = [(1, "http://a.b.example.org/p/q", START), (2, "http://bexample.org/", START), (3, "http://example.org/p", START)]
    for level, key, hit in [
        ("domain", "b.example.org", {1}), ("domain", "Example.ORG.", {1, 3}), ("domain", "org", {1, 2, 3}), ("host", "example.org", {3}),
        ("path", "a.b.example.org/p/", {1}), ("path", "A.b.example.org//p/q", {1}), ("path", "a.b.example.org/p/q/r", set()), ("path", "example.org/p", {3}),
    ]:
        df = spark.createDataFrame(captures, "page_id long, url string, fetched_on date")
        got = evaluate(df, spark.createDataFrame([(level, key, START, "block")], ENTRIES)).where("NOT kept").collect()
        assert {r["page_id"] for r in got} == hit


def test_intervals_follow_each_other(spark):
    log = [("host", "h", START + timedelta(d), a) for d, a in [(5, "block"), (1, "allow"), (5, "allow"), (9, "allow")]]
    got = sorted((r["listed_on"].day, r["until"] and r["until"].day, r["blocks"]) for r in intervals(spark.createDataFrame(log, ENTRIES)).collect())
    assert got == [(2, 6, False), (6, 10, True), (10, None, False)]


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "")], "page_id long, url string, html string")
    captures = dated_captures(pages)
    assert evaluate(captures, dated_list(pages).limit(0)).first()["verdict"] == "unlisted"
    assert evaluate(captures.limit(0), dated_list(pages)).count() == 0
    assert dated_list(pages).count() == 9


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "")], "page_id long, url string, html string")
    assert not re.search("Python|Arrow|Pandas", evaluate(dated_captures(pages), dated_list(pages))._jdf.queryExecution().toString())
