"""Main text of pages: layouts, damage, and every given page."""

from __future__ import annotations

import html as references
import os
import re
import time

import pytest

from firstseen.llm import html_text

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LONG = "The main text of this page is long enough to matter, with several words in it."

PAGES = [
    (None, ""),
    ("", ""),
    ("no markup &lt;here&gt; &amp; there", "no markup <here> & there"),
    (f"<body><nav><a href=x>Menu</a></nav><article><h1>T</h1><p>{LONG}<p>b <i>c</i>d<br>e</article><footer>f</footer>", f"T\n\n{LONG}\n\nb cd e"),
    (f"<div class='site-header'>H</div><div id=content><p>{LONG}</p><p>{LONG}</p></div><div class=comments><p>{LONG}{LONG}</p></div>", f"{LONG}\n\n{LONG}"),
    (f"<main><h1>A</h1><div><p>{LONG}</p><p>{LONG}</p></div></main><aside>{LONG}</aside><form>{LONG}</form>", f"A\n\n{LONG}\n\n{LONG}"),
    (f"<article><p>{LONG}</p><script>if (a<b) x('</p>')</script><style>p{{}}</style><p>z</p></article>", f"{LONG}\n\nz"),
    (f"<article><p>{LONG}</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", f"{LONG}\n\none\n\ntwo\n\nx\n\ny"),
    (f"<article><p title='a > b'>{LONG}</p><!-- <p>no --><p>q &copy; &#233; &nbsp; r</p><p", f"{LONG}\n\nq © é r"),
    (f"<article><p>{LONG} &am", f"{LONG} &am"),
    (f'<article><p broken="a>{LONG}</p><p>{LONG}</p></article>', f"{LONG}\n\n{LONG}"),
    ("<script>only()", ""),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_layouts(page, text):
    assert html_text.main_text(page) == text


TEXT = f"<h1>A</h1><p>{LONG}</p><p>{LONG} b</p>"
READ = f"A\n\n{LONG}\n\n{LONG} b"
MARKED = [
    *((f"<body><div {mark}>{TEXT}</div></body>", READ) for mark in (
        "class='content no-sidebar'", "id='page' class='header-fixed'", "class='wrapper has-sidebar'", "class='sidebar-right'", "id=header")),
    *((f"<body><div {mark}><article>{TEXT}</article></div><p>x</p></body>", READ) for mark in ("class='layout no-sidebar'", "class=modal")),
    *((f"<article>{TEXT}<{name} {mark}><p>{LONG} c</p></{name}></article>", f"{READ}\n\n{LONG} c") for name, mark in (
        ("section", "id='related-work'"), ("div", "class='social-history'"), ("div", "class='article-header'"))),
    (f"<body>{TEXT}<section id='related-work'><p>{LONG} c</p></section></body>", f"{READ}\n\n{LONG} c"),
    # Furniture still goes, inside an article and where it is longer than the text.
    (f"<article>{TEXT}<div class='ad'>Buy</div><div class='post-share'>x</div><div class='related-posts'><p>{LONG}</p></div></article>", READ),
    (f"<article>{TEXT}<div class='related-reading'><a href=x>{LONG}</a></div></article>", READ),
    (f"<div id=content>{TEXT}</div><div class='comments'>{f'<p>{LONG} d</p>' * 9}</div>", READ),
    (f"<div id=content><p>{LONG}</p><p>{LONG}</p></div><div class='comment-list'>{f'<p>{LONG}</p>' * 3}</div>", f"{LONG}\n\n{LONG}"),
]


@pytest.mark.parametrize(("page", "text"), MARKED)
def test_classes_of_layouts_and_topics(page, text):
    assert html_text.main_text(page) == text


AROUND = [
    # A head that is not closed.
    (f"<html><head><title>x</title><body><article>{TEXT}</article></body></html>", READ),
    (f"<head><title>x</title><p>{LONG}</p><p>{LONG}</p>", f"{LONG}\n\n{LONG}"),
    (f"<head><meta charset=utf-8>{LONG}<p>{LONG}</p>", f"{LONG}\n\n{LONG}"),
    # Furniture around the whole page; what is inside as such still goes.
    (f"<body><form id=aspnetForm><nav><a href=x>Menu</a> {LONG}</nav>{TEXT}<footer>{LONG}</footer></form></body>", READ),
    (f"<body><form><div><p>{LONG}</p><p>{LONG}</p></div><input><button>Go</button></form></body>", f"{LONG}\n\n{LONG}"),
    (f"<body><nav><a href=x>M</a></nav><div role=complementary><article>{TEXT}</article></div><footer>{LONG}</footer></body>", READ),
    (f"<body><aside><form><article>{TEXT}</article></form><aside>{LONG}</aside></aside></body>", READ),
    (f"<body>{TEXT}<form><p>{LONG}</p></form><div role=complementary><p>{LONG}</p></div></body>", READ),
    (f"<body><p>{LONG}</p><footer>{f'<p>{LONG}</p>' * 9}</footer></body>", LONG),
    (f"<body><header><h1>Site</h1></header><div><p>{LONG}</p><p>{LONG}</p></div></body>", f"{LONG}\n\n{LONG}"),
    # Empty comments.
    (f"<article><!--><p>{LONG}</p><!---><p>{LONG}</p><!-- x --></article>", f"{LONG}\n\n{LONG}"),
    # A title and a lead outside the densest element.
    (f"<body><div class=hero><h1>T</h1><p>lead</p></div><div class=body>{f'<p>{LONG}</p>' * 3}</div></body>", f"T\n\nlead\n\n{LONG}\n\n{LONG}\n\n{LONG}"),
    (f"<body><div><a href=x>Home</a> <a href=y>Other</a></div><div><h1>T</h1></div><div>{f'<p>{LONG}</p>' * 2}</div><div><p><a href=z>{LONG}</a></p></div><div>Top</div></body>", f"T\n\n{LONG}\n\n{LONG}"),
]


@pytest.mark.parametrize(("page", "text"), AROUND)
def test_what_is_around_the_text(page, text):
    assert html_text.main_text(page) == text


N = 64_000
DEEP = ["<font>x" * N, "<div>" * N + "</b></section>" * N, "<b><div>x</b>" * N, "<p><button>" + "<div>" * N, "<a href=x>" * N,
        "<form><div>x" * (N // 2), "<div>x" * N + "</div><p>y" * N, "<ul><li>x" * (N // 2)]


@pytest.mark.parametrize("page", DEEP, ids=range(len(DEEP)))
def test_deep_pages_take_time_by_length(page):
    start = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - start < 6


@pytest.mark.parametrize("page", ["<" * 3000, '<a b="' * 2000, "<div>" * 3000 + "x", "<p>" * 3000, "</b>" * 3000, "<!--" * 2000, "<a " + "x" * 50_000])
def test_damage_ends(page):
    html_text.main_text(page)


def test_every_given_page(spark):
    """These pages have one article of a heading and paragraphs."""
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    found = {r.page_id: r for r in html_text.extract(pages.withColumn("text", pages.html)).collect()}
    assert len(found) == pages.count()
    for row in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|<footer|$)", row.html, re.S)[1]
        inside = re.sub(r"</?b>|<[^>]*$", "", inside).replace("<br>", " ")
        blocks = [" ".join(references.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        text = "\n\n".join(b for b in blocks if b)
        assert found[row.page_id].text == text and found[row.page_id].n_chars == len(text)


def test_nulls_and_no_pages(spark):
    schema = "page_id bigint, url string, html string, n_chars string"
    rows = [(None, None, None, None), (1, "u", f"<p>{LONG}", "x"), (1, "u", f"<p>{LONG}", "x")]
    found = sorted(map(tuple, html_text.extract(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert found == sorted([(None, None, "", 0), (1, "u", LONG, len(LONG)), (1, "u", LONG, len(LONG))], key=str)
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
