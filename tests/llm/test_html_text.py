"""Page differencing with copies and beside an article."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import html_text


def texts(spark, pages):
    rows = [(k, url, "<html><body>" + "".join(f"<{tag}>{t}</{tag}>" for tag, t in body) + "</body></html>") for k, (url, body) in enumerate(pages)]
    return [r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()]


def bare(own):
    return [("div", "Top of the site"), *(("p", t) for t in own), ("div", "End of the site")]


def test_template_of_bare_pages_goes(spark):
    got = texts(spark, [(f"https://a.example/{k}", bare([f"own {k}", "more"])) for k in (1, 2)])
    assert got == ["own 1", "own 2"]


@pytest.mark.parametrize("paths", [("x/1", "x/1", "x/1", "x/2"), ("x/2", "x/3", "x/3", "x/1"), ("x/1", "y/1", "z/1", "x/2")])
def test_bare_copies_keep_their_text(spark, paths):
    pages = [(f"https://a.example/{p}", bare(["other"] if k == 3 else ["own"])) for k, p in enumerate(paths)]
    assert texts(spark, pages) == ["own"] * 3 + ["other"]


def test_a_host_of_copies_keeps_all(spark):
    assert texts(spark, [("https://a.example/1", bare(["own"]))] * 3) == ["Top of the site\nown\nEnd of the site"] * 3


def test_text_outside_a_short_article_is_judged_and_the_article_stays(spark):
    pages = [(f"https://a.example/{k}", [("div", "Top of the site"), ("article", "teaser"), ("p", f"own {k}"), ("nav", "menu"), ("div", "End of the site")]) for k in (1, 2)]
    assert texts(spark, pages) == ["teaser\nown 1", "teaser\nown 2"]


def dense(a, b):
    length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            length[i + 1][j + 1] = length[i][j] + 1 if x == y else max(length[i][j + 1], length[i + 1][j])
    return length[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=40), st.lists(st.integers(0, 6), max_size=40))
def test_alignment_is_a_longest_common_subsequence(a, b):
    kept = html_text.shared(np.array(a, np.int64), np.array(b, np.int64))
    assert kept.sum() == dense(a, b)
    rest = iter(b)
    assert all(x in rest for x, keep in zip(a, kept) if keep)


def test_alignment_of_long_pages_takes_little_memory():
    own, other = np.arange(20_000) % 977, (np.arange(20_000) * 3) % 977
    assert 0 < html_text.shared(own, other).sum() < 20_000


def test_every_page_is_paired_over_empty_parts_and_hosts_of_one(spark):
    pages = [(f"https://{'ab'[k % 2]}.example/{k:03}", [("div", "Top of the site"), ("article", f"own {k}"), ("div", f"only here {k}")]) for k in range(30)] + [("https://c.example/", [("div", "Top of the site"), ("article", "lone")])]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = texts(spark, pages)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == [f"own {k}\nonly here {k}" for k in range(30)] + ["Top of the site\nlone"]


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (2, "no scheme", "", "x"), (None, "https://a.example/", "<p>A &amp; B\n  C</p>", "x"), (3, "https://a.example/", "<p>A &amp; B C</p>", "x"), (3, "https://a.example/", "<p>A &amp; B C</p>", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(frame).collect())) == [(0, "A & B C", 7), (1, "", 0), (2, "", 0), (3, "A & B C", 7), (3, "A & B C", 7)]
    assert html_text.extract(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page,text",
    [
        ('<body class="home has-sidebar page-with-comments"><p>text</p></body>', "text"),
        ('<div class="content has-comments"><article><p>text</p></article></div>', "text"),
        ('<article class="post related"><p>text</p></article>', "text"),
        ('<section id="social-history"><p>text</p></section>', "text"),
        ('<div class="widget"><article><p>text</p></article><p>other</p></div>', "text"),
        ('<main class="sidebar"><p>text</p></main>', "text"),
        ("<article><p>text<button>Buy now</button><span class='advert'>AD</span><span hidden>x</span> goes on</p></article>", "text goes on"),
        ("<p title=it's>text</p><p>it's</p>", "text\nit's"),
        ('<p title="a > b" data-x=\'"\'>text</p>', "text"),
        ('<p>text</p><div id="comments"><article class="comment"><p>no</p></article></div>', "text"),
        ('<p>text</p><div class="comment-list">no</div><div class="sidebar-left">no</div><div class="cookie-banner">no</div>', "text"),
        ('<article><p>text</p><aside>no</aside><div class="share">no</div><section class="reply">no</section></article>', "text"),
        ('<p>text <a class="related">more</a></p>', "text more"),
        ('<span class="ad">unclosed <p>text</p>', "unclosed\ntext"),
        ('<span class="ad">no <span>no</span></span><p>text</p>', "text"),
        ('<div><span class="ad">no</div><p>text</p><span>more</span>', "text\nmore"),
        ("<img alt=a/><br/><p>text</p>", "text"),
    ],
)
def test_known_pages(spark, page, text):
    frame = spark.createDataFrame([(1, "https://a.example/1", f"<html>{page}</html>")], "page_id long, url string, html string")
    assert html_text.extract(frame).first().text == text


def test_a_site_where_differencing_alone_decides(spark):
    """No element or class tells the template: lines before, between and after the text, two of which differ by section."""
    rows = []
    for k in range(30):
        section = k % 3
        lines = ["Site of things", f"Section {section}", f"Story {k} begins", "Read this too", f"Story {k} goes on", f"Story {k} ends", "Contact us", "All rights"]
        rows.append((k, f"https://a.example/s{section}/p{k:02d}", "<body>" + "".join(f"<div>{t}</div>" for t in lines) + "</body>"))
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {k: f"Story {k} begins\nStory {k} goes on\nStory {k} ends" for k in range(30)}
    assert {(r.n_lines, r.n_shared) for r in found} == {(8, 5)}
