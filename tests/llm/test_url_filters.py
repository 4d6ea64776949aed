"""Block decisions over aliases against a plain union-find."""

import random

import duckdb
import pytest

from factloom.llm import url_filters
from factloom.llm.common import components


def plain(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("kind", ["chain", "star", "loop", "random", "grid"])
def test_components(spark, kind):
    rng = random.Random(1)
    edges = {
        "chain": [(k, k + 1) for k in range(200)],
        "star": [(500, k) for k in range(400)] + [(k, 1000 + k) for k in range(50)],
        "loop": [(k, (k + 1) % 31) for k in range(31)] + [(40, 41), (41, 40)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(170)],
        "grid": [(100 * i + j, 100 * i + j + 1) for i in range(9) for j in range(9)] + [(100 * i, 100 * i + 100) for i in range(8)],
    }[kind]
    found = components(spark.createDataFrame(edges + [(None, 1), (7, 7)], "a long, b long"))
    assert {r.node: r.label for r in found.collect()} == plain([e for e in edges if e[0] != e[1]])


def page(canonical=None, refresh=None, hidden=""):
    link = f'<link rel="canonical" href="{canonical}">' if canonical else ""
    meta = f'<meta http-equiv="refresh" content="0; url={refresh}">' if refresh else ""
    return f"<html><head>{hidden}{link}{meta}</head><body>x</body></html>"


PAGES = [
    ("http://a.test/1", page(refresh="http://a.test/2"), "block"),
    ("http://a.test/2", page(refresh="/3"), "block"),
    ("http://a.test/3", page(canonical="https://bad.net/x"), "block"),
    ("https://bad.net/x", page(), "block"),
    ("http://b.test/1", page(canonical="http://b.test/2"), "allow"),
    ("http://b.test/2", page(canonical="http://b.test/1"), "allow"),
    ("http://c.test/1", page(canonical="https://bad.net/y"), "allow"),
    ("http://c.test/1", page(canonical="https://www.example.net/en/1"), "allow"),
    ("http://d.test/d/1", page(canonical="2?a=1&amp;b=2"), "block"),
    ("http://d.test/d/2?a=1&b=2", page(refresh="https://bad.net/z"), "block"),
    ("http://e.test/1", page(hidden='<!-- <link rel="canonical" href="https://bad.net/x"> -->'), "allow"),
    ("http://f.test/1", page(hidden="<script>var a='<link rel=canonical href=https://bad.net/x>'</script>"), "allow"),
    ("HTTP://EXAMPLE.NET/en/x", None, "allow"),
    (None, page(canonical="https://bad.net/x"), "allow"),
    ("no scheme", "", "allow"),
] + [(f"http://hub.test/{k}", page(canonical="https://bad.net/hub"), "block") for k in range(60)]


def test_decisions_follow_aliases(spark):
    frame = spark.createDataFrame([(k, u, h) for k, (u, h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_filters.judge(frame).collect()} == {k: v for k, (_, _, v) in enumerate(PAGES)}
    assert url_filters.judge(frame.limit(0)).count() == 0


def test_sql_gives_the_same_rows(spark):
    own = [(k, u, h) for k, (u, h, _) in enumerate(PAGES) if u not in ("http://a.test/2", "http://d.test/d/1")]
    found = url_filters.judge(spark.createDataFrame(own, "page_id long, url string, html string"))
    pages = found.sparkSession.createDataFrame(own, "page_id long, url string, html string").toPandas()
    con = duckdb.connect()
    con.register("pages", pages)
    expected = con.sql(f"SELECT {', '.join(found.columns)} FROM ({url_filters.ORACLE})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(expected)
