"""URL rules."""

import random
import re

import pytest
from helpers import rows_of

from genoframe.llm import urls
from genoframe.llm.urls import GlobAutomaton, UrlRule

CASES = [
    # url, host, path, rule, verdict
    ("https://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("https://example.org/es", "example.org", "/es", "org/", "allow"),
    ("http://EXAMPLE.org/en/12?x", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://x.example.org/EN/1", "x.example.org", "/EN/1", "org/", "allow"),
    ("http://myexample.org/es/", "myexample.org", "/es/", "org/", "allow"),
    ("http://b.com/fr/x#y", "b.com", "/fr/x", "com/fr/", "allow"),
    ("http://b.com/de/", "b.com", "/de/", "com/de/", "block"),
    ("http://b.com/x/de/", "b.com", "/x/de/", None, "allow"),
    ("http://org", "org", "", None, "allow"),
    ("http://org/", "org", "/", "org/", "allow"),
    ("http://borg/", "borg", "/", None, "allow"),
    ("http://spam-farm.net/", "spam-farm.net", "/", None, "block"),
    ("http://oil-spills.noaa.net/", "oil-spills.noaa.net", "/", None, "allow"),
    ("http://antispam.net/", "antispam.net", "/", None, "allow"),
    ("http://best_PILLS.shop.net:8080/a", "best_pills.shop.net:8080", "/a", None, "block"),
    ("http://shop.net.xxx", "shop.net.xxx", "", None, "block"),
    ("http://ok.net/spam/", "ok.net", "/spam/", None, "allow"),
    ("http://spam.example.org/", "spam.example.org", "/", "org/", "allow"),
    ("http://a.org?u=http://b.com/de/", "a.org", "", None, "allow"),
    ("http://a.org:80/", "a.org:80", "/", None, "allow"),
    ("http://é.org/ü", "é.org", "/ü", "org/", "allow"),
    ("no scheme", "", "", None, "block"),
    ("", "", "", None, "block"),
    (None, "", "", None, "block"),
    ("http:///de/", "", "/de/", None, "block"),
    ("http://a.com/fr/" + "x" * 70_000, "a.com", "/fr/" + "x" * 70_000, "com/fr/", "allow"),
]


def test_rules_hosts_and_paths(spark):
    rows = [(i, case[0], "<p>", 1, 2) for i, case in enumerate(CASES)] * 2
    schema = "page_id bigint, url string, html string, host int, verdict int"
    found = rows_of(urls.filter_urls(spark.createDataFrame(rows, schema)))
    assert found == sorted([(i, *case[1:]) for i, case in enumerate(CASES)] * 2, key=repr)
    assert rows_of(urls.filter_urls(spark.createDataFrame([], schema))) == []


def plain(glob, text):
    return re.fullmatch(b".*".join(map(re.escape, glob.split(b"*"))), text, re.DOTALL) is not None


@pytest.mark.parametrize("seed", range(5))
def test_automaton_equals_plain_matching(seed):
    pick = random.Random(seed)
    globs = ["".join(pick.choices("ab*.", k=pick.randint(0, 9))) for _ in range(40)]
    texts = ["".join(pick.choices("ab.", k=pick.randint(0, 12))).encode() for _ in range(200)]
    automaton = GlobAutomaton(globs)
    assert automaton.words > 1
    found = automaton.matches(texts)
    for i, text in enumerate(texts):
        assert found[i].tolist() == [plain(glob.encode(), text) for glob in globs]


def test_many_rules_and_more_urls_than_lanes(monkeypatch):
    monkeypatch.setattr(urls, "LANES", 7)
    automaton = GlobAutomaton([f"host{i}.net/*" for i in range(300)])
    found = automaton.matches([f"host{i}.net/x".encode() for i in range(300)])
    assert (found == (found.cumsum(1) == 1) * found).all() and found.diagonal().all()
    assert found.sum() == 300


def test_own_rules(spark):
    rules = (UrlRule("net", "/", "block"), UrlRule("a.net", "/x", "allow"))
    pages = spark.createDataFrame([(1, "http://a.net/xy"), (2, "http://b.net/x")], "page_id int, url string")
    found = rows_of(urls.filter_urls(pages, rules, ()))
    assert [row[3:] for row in found] == [("a.net/x", "allow"), ("net/", "block")]


def test_rule_hosts_in_paths_do_not_count(spark):
    cases = [
        ("https://web.archive.net/web/http://www.example.org/es/1", None, "allow"),
        ("https://x.com/fr/a.example.org/es/1", "com/fr/", "allow"),
        ("https://casino.net/mirror/a.org/", None, "block"),
        ("https://x.net/a.com/de/", None, "allow"),
        ("https://www.example.org/es/b.com/fr/", "example.org/es/", "block"),
    ]
    pages = spark.createDataFrame([(i, case[0]) for i, case in enumerate(cases)], "page_id int, url string")
    assert [row[3:] for row in rows_of(urls.filter_urls(pages))] == [case[1:] for case in cases]


def test_rule_without_a_path_binds_the_whole_host(spark):
    rows = [(1, "http://a.net"), (2, "http://x.a.net/y"), (3, "http://a.network/y")]
    pages = spark.createDataFrame(rows, "page_id int, url string")
    found = rows_of(urls.filter_urls(pages, (UrlRule("a.net", "", "block"),), ()))
    assert [row[3:] for row in found] == [("a.net", "block"), ("a.net", "block"), (None, "allow")]
