"""op4: hashed URL expressions against a plain loop over all rules."""

import re

import pytest

from meterflow.llm import urlrules
from tests.llm import tables

URLS = [
    None, "", "no scheme", "http://", "http://a.com", "http://A.Com/x", "https://example.com/en/1?x=/es/",
    "https://www.example.com/en/", "http://m.www.example.com/en/x#y", "http://example.net/es/1", "http://net/es/",
    "http://x.net/fr", "http://x.net/fr/?q", "ftp://notexample.com/en/1", "http://example.com/en", "http://a.b.c.d.e.org/",
    "x://y://net/fr/", "http://net?/fr/", "http://example.com.net/fr/\u00e9", "HTTP://EXAMPLE.COM/EN/",
]


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (m[1].translate(lower), m[2]) if m else ("", "")


def brute(url, rules):
    host, path = split(url)
    fits = [
        (len(h) + len(p), len(h), h + p, v)
        for v, h, p in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *max(fits)[2:]) if fits else (host, path, None, "allow")


@pytest.mark.parametrize(
    "rules",
    [
        urlrules.QUERY_RULES,
        [("block", "com", ""), ("allow", "a.com", "/x"), ("block", "e.org", "/"), ("allow", "com", ""), ("block", "net", "/f")],
    ],
)
def test_against_all_rules(spark, rules):
    rows = tables.pages(spark, [(i, u, None) for i, u in enumerate(URLS + URLS[:4])])
    got = urlrules.judge(rows, urlrules.rules_table(spark, rules))
    assert got.columns == [*rows.columns, "host", "path", "rule", "verdict"]
    strict = {}
    for v, h, p in rules:  # a rule listed as both blocks
        strict[h, p] = max(v, strict.get((h, p), ""))
    rules = [(v, h, p) for (h, p), v in strict.items()]
    want = sorted(((i, *brute(u, rules)) for i, u in enumerate(URLS + URLS[:4])), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=str) == want


def test_empty_tables(spark):
    some, none = tables.pages(spark, [(1, "http://a.com/", "x")]), tables.no_rows(spark, tables.PAGES)
    rules = urlrules.rules_table(spark, urlrules.QUERY_RULES)
    assert urlrules.judge(none, rules).count() == 0
    row = urlrules.judge(some, rules.limit(0)).first()
    assert (row.rule, row.verdict, row.host, row["_host"]) == (None, "allow", "a.com", "h")


def test_short_hash_does_not_decide(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "PREFIX_HEX", 1)
    rows = tables.pages(spark, [(i, f"http://h{i}.com/p{i}", None) for i in range(60)])
    rules = [("block", f"h{i}.com", f"/p{i}") for i in range(0, 60, 2)]
    got = urlrules.judge(rows, urlrules.rules_table(spark, rules)).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(0, 60, 2))


def test_no_python_in_the_plan(spark, capsys):
    urlrules.query(spark, "/root/testdata/sf0.001").explain("formatted")
    assert not re.search("Python|Pandas|ArrowEval|ExistingRDD", capsys.readouterr().out)
