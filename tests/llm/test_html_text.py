"""Main text of pages: known articles in varied page frames, odd markup, and the given tables."""

from __future__ import annotations

import html
import random
import re
import time

import pytest

from tabulith.llm.html_text import extract, main_text, op12_html_text
from tests.conftest import DATA

SENTENCE = "The quick brown fox, which had slept, went over the hill, and the river & back again. "
PARAGRAPHS = [(SENTENCE * k).strip() for k in (3, 5, 2, 4)]
ARTICLE = "A title here\n" + "\n".join(PARAGRAPHS)


def marked(tag="p"):
    return "<h1>A title here</h1>" + "".join(f"<{tag}>{html.escape(p)}</{tag}>" for p in PARAGRAPHS)


NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News, sport, and more news of the day</a></li></ul></nav>'
FOOTER = "<footer><p>&copy; Someone, somewhere, sometime. All rights, as ever, reserved for those who hold them.</p></footer>"
AD = '<div class="ad">Buy this, buy that, and buy some more of it, today, tomorrow, and the day after that.</div>'
COMMENTS = '<section id="comments"><p>' + SENTENCE * 6 + "</p><p>I agree, fully, with all of it.</p></section>"
ASIDE = "<aside><p>" + SENTENCE * 4 + "</p></aside>"
COOKIES = '<div class="cookie-notice"><p>We use cookies, and more cookies, to make things better, faster, and sweeter for you.</p></div>'
FORM = '<form action="/q"><label>Your mail, please</label><input name="m"><button>Send</button><p>Sign up now, at once, or never.</p></form>'

FRAMES = {
    "article": f"<html><head><title>A title here</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>{NAV}{AD}<article>{marked()}</article>{FOOTER}</body></html>",
    "divs": f'<html><body><div id="header"><h2>Site name, and its motto</h2></div><div class="main-menu"><a href="/">Home</a></div><div id="content">{marked()}{AD}</div><div class="sidebar"><p>{SENTENCE * 3}</p></div><div id="footer">Imprint, contact, terms</div></body></html>',
    "plain_names": f'<body><div class="c1"><ul><li><a href="/1">One thing, two things</a></li><li><a href="/2">Three things, and four</a></li></ul></div><div class="c2">{marked()}</div><div class="c3"><a href="/x">More, and more, and more of the very same</a></div></body>',
    "all_notices": f"<body>{COOKIES}{NAV}<main>{marked()}{FORM}{COMMENTS}</main>{ASIDE}{FOOTER}",
    "within_article": f"<body><article><header>{marked()[: len('<h1>A title here</h1>')]}</header>{marked()[len('<h1>A title here</h1>') :]}{ASIDE}{FORM}{COMMENTS}</article></body>",
    "unclosed": "<html><body><nav><ul><li><a href=/>Home<li><a href=/n>News</a></ul></nav><article><h1>A title here</h1>" + "".join(f"<p><b>{html.escape(p)}<br>" for p in PARAGRAPHS) + "</article><footer>Imprint",
    "parts": '<body><div class="post"><h1>A title here</h1><div class="s1">' + "".join(f"<p>{html.escape(p)}</p>" for p in PARAGRAPHS[:2]) + '</div><div class="s2">' + "".join(f"<p>{html.escape(p)}</p>" for p in PARAGRAPHS[2:]) + f"</div></div>{COMMENTS}</body>",
    "inline": "<body><article><h1>A <em>title</em> here</h1>" + "".join("<p>" + html.escape(p).replace("brown fox", '<a href="/f?a=1&b=2>"><i>brown</i>\n  fox</a>').replace("river", "<span class='x>y'>ri</span>ver") + "</p>" for p in PARAGRAPHS) + "</article>",
    "comment_in_markup": f"<body><!-- <p>not this, no, not this</p> -->{NAV}<!-- ad > 1 --><article>{marked()}<!-- unclosed > <p>nor this, nor that</article>",
    "hidden": f'<body class="has-sidebar no-ads"><div style="display: none"><p>{SENTENCE * 9}</p></div><p hidden>{SENTENCE}</p><article class="with-comments">{marked()}</article><div aria-hidden="true">{SENTENCE * 3}</div>',
    "named_around_main": f'<body><div class="sidebar-layout"><div class="sidebar"><p>{SENTENCE}</p></div><main>{marked()}</main></div></body>',
    "upper": f"<HTML><BODY>{NAV.upper()}<ARTICLE>{marked().replace('<p>', '<P>').replace('</p>', '</P >')}</ARTICLE></BODY>",
}


@pytest.mark.parametrize("name", FRAMES)
def test_frames(name):
    assert main_text(FRAMES[name]) == ARTICLE


def test_all_kinds_of_blocks_stay():
    page = "<article><h2>Head</h2><p>One, two.</p><ul><li>First</li><li>Second <b>bold</b></li></ul><blockquote><p>Said\tso.</p></blockquote><table><tr><td>a</td><td>b</td></tr></table><pre>x  =\n 1</pre>loose text<dl><dt>T<dd>D</dl><p>&lt;tag&gt; &eacute;&#233;&#xe9; &nbsp; &unknown; &amp</p></article>"
    assert main_text(page).split("\n") == ["Head", "One, two.", "First", "Second bold", "Said so.", "a", "b", "x = 1", "loose text", "T", "D", "<tag> ééé &unknown; &"]


def test_short_articles_go_before_long_frames():
    assert main_text(f"<body>{NAV}{AD}<article><h1>Of.</h1><p>Of.</p></article>{FOOTER}") == "Of.\nOf."
    assert main_text("just text, no markup") == "just text, no markup"
    assert main_text("<p>one<p>two") == "one\ntwo"
    assert main_text(f'<div class="ad"><p>{SENTENCE}</p></div>') == SENTENCE.strip()  # nothing else: names alone don't empty a page


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x</p>"), (3, "u", "<"), (4, "u", "</"), (5, "u", "<p"), (6, "u", "<!--"), (7, "u", "a < b <3 & c"), (8, "u", "<script>x"), (9, "u", " \n "), (9, "u", "<article><p>x</p>"), (9, "u", "<article><p>x</p>"), (10, "u", "<p>\0a\0</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'odd' AS text", "1 AS n_chars").repartition(3)
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract(pages).collect()), key=repr)
    want = ["", "", "x", "", "", "", "", "a < b <3 & c", "", "", "x", "x", "a"]
    want[3] = "<"
    assert got == sorted(((i, u, t, len(t)) for (i, u, _), t in zip(rows, want, strict=True)), key=repr)
    assert extract(pages.where("page_id = 77")).collect() == []


@pytest.mark.parametrize("unit", ["<", "<a ", "<p class=\"x ", "<p a='", "<a =\"' ", "<!-- ", "</x", "<div>", "<div><p>x", "<li>", "<b><i>", "&amp", "<script>", "<a href=x>y", "<td>a", "<p x= = =  ", "<article><p>a, b</p>", "<li><ul><div><li></li>", "<div></p>"])
def test_malformed_pages_take_time_in_proportion(unit):
    page, began = unit * (300_000 // len(unit)), time.time()
    main_text(page)
    assert time.time() - began < 20


def test_any_tags_at_all():
    """No page of random markup breaks it, and no text is made up."""
    rng = random.Random(2)
    some = ["<p>", "</p>", "<div>", "</div>", "<article>", "</article>", "<li>", "<ul>", "</ul>", "<table>", "<td>", "<a href='x'>", "</a>", "<h2>", "</h2>", "<nav>", "</nav>", "<br>", "<!--", "-->", "<script>", "</script>", "word, ", "other. ", "&lt;", "<main>", "</main>", '<div class="ad">', "<form>", "</form>", "\n"]
    for _ in range(1000):
        text = main_text("".join(rng.choices(some, k=rng.randint(1, 40))))
        assert set(re.findall(r"\w+", text)) <= {"word", "other"}, text


def test_given_pages(spark):
    """In the given tables an article is what stands between its tags: a heading and paragraphs."""
    folder = str(DATA / "sf0.01")
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in op12_html_text(spark, folder).collect():
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)
