import random

import pytest

from barlake.llm.components import components
from barlake.llm.common import Scratch
from barlake.llm.queries import RULES
from barlake.llm.url_filter import Rule, judge

PAGES = "page_id bigint, url string, html string, host string, bad string"


def verdicts(spark, rows, rules=RULES, redirects=None):
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES)
    if redirects is not None:
        redirects = spark.createDataFrame(redirects, "source string, target string")
    return [tuple(r) for r in judge(frame, rules, redirects).collect()]


def test_rules_by_host_path_and_length(spark):
    rows = [
        (1, "http://WWW.Example.COM/en/a?q#f", None), (2, "http://a.example.com/en/", None), (3, "http://example.com", None),
        (4, "http://x.net/fr/1", None), (5, "http://x.net/de/", None), (6, None, None), (7, "no scheme", None),
        (8, "http://notexample.com/en/", None), (9, "", None), (9, "", None), (10, "http://h/p://q/r", None),
    ]
    got = {r[0]: r[1:5] for r in verdicts(spark, rows)}
    assert got == {
        1: ("www.example.com", "/en/a", "www.example.com/en/", "allow"),
        2: ("a.example.com", "/en/", "example.com/en/", "block"), 3: ("example.com", "", None, "allow"),
        4: ("x.net", "/fr/1", "net/fr/", "block"), 5: ("x.net", "/de/", None, "allow"), 6: ("", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("notexample.com", "/en/", "com/", "allow"), 9: ("", "", None, "allow"),
        10: ("h", "/p://q/r", None, "allow"),
    }
    assert len(verdicts(spark, rows)) == len(rows)


def test_blocks_reach_aliases_but_no_explicit_allow(spark):
    rows = [
        (1, "http://a.org/x", '<link rel="canonical" href="https://b.net/fr/1">'),
        (2, "https://c.org/y#top", "<META http-equiv=refresh content=\"0; url=http://a.org/x\">"),
        (3, "http://d.com/z", "<link href='//a.org/x' rel=canonical>"),
        (4, "http://e.org/", "<link rel=stylesheet href=http://a.org/x>"),
        (5, "http://f.org/dir/page", "<link rel=canonical href=other?a=1&amp;b=2>"),
        (6, "http://g.org/", "<link rel=canonical href=mailto:x@y>"),
    ]
    got = {r[0]: r[3:] for r in verdicts(spark, rows, redirects=[("http://seen.org/", "http://c.org/y"), (None, "http://q.org/")])}
    assert got[1] == (None, "block", "a.org/x", True)
    assert got[2] == (None, "block", "a.org/x", True)
    assert got[3] == ("com/", "allow", "a.org/x", False)
    assert got[4] == got[6] == (None, "allow", None, False)
    assert got[5] == (None, "allow", "f.org/dir/other?a=1&b=2", False)


def test_no_rules_no_pages(spark):
    assert verdicts(spark, [(1, "http://a.net/fr/", None)], rules=[])[0][4] == "allow"
    assert verdicts(spark, []) == []


def test_equal_rules_block(spark):
    rules = [Rule("allow", "a.org", "/"), Rule("block", "a.org", "/")]
    assert verdicts(spark, [(1, "http://a.org/", None)], rules)[0][4] == "block"


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components_against_union_find(spark, shape):
    rng = random.Random(5)
    edges = {
        "path": [(i, i + 1) for i in range(200)] + [(900, 901)],
        "star": [(500, i) for i in range(300)] + [(7, 7), (None, 3), (600, 500), (600, 500)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(260)],
    }[shape]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = [tuple(r) for r in components(frame, Scratch(spark, "test")).collect()]
    assert sorted(got) == sorted((n, find(n)) for n in list(parent))
