"""Main text of whole pages, the cut against all labellings, and broken markup."""

import html
import itertools
import random
import re

from snapmart.llm import queries
from snapmart.llm.html_extract import blocks, cut, extract, main_text

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="home">
<div class="cookie-notice"><p>We use cookies, and more cookies. Accept them all now, please.</p></div>
<header><h2>Site name</h2><nav><a href="/">Home</a> <a href="/b">About</a></nav></header>
<div id="content"><h1>A title &amp; more</h1>
<p>First paragraph with <b>bold</b>, a <a href="x">link</a> and&nbsp;enough words to read.
<p>Second one, unclosed, it also has a good number of words in it.
<ul><li>First item of the list, which is text<li>Second item of the list, text too</ul>
<div class="ad"><p>Buy this wonderful thing, it is cheap, and it is good for you.</p></div>
<blockquote>Quoted words that someone said, long ago, in a book.</blockquote>
<script>var x = "<p>not text</p>";</script><p>Last words 1 &lt; 2.</p></div>
<aside><p>Related: some other story that you may like, or not.</p></aside>
<section class="comments"><h3>Comments</h3><p>I liked the article very much, thank you, it was good.</p></section>
<form><label>Name</label><input><button>Send</button></form>
<footer>Copyright &copy; 2020, all rights reserved, by the owners.</footer></body></html>"""


def test_a_page():
    assert main_text(PAGE) == "\n".join([
        "A title & more", "First paragraph with bold, a link and enough words to read.",
        "Second one, unclosed, it also has a good number of words in it.",
        "First item of the list, which is text", "Second item of the list, text too",
        "Quoted words that someone said, long ago, in a book.", "Last words 1 < 2."])


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randrange(1, 9)
        lean = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4]

        def cost(labels):
            return sum(x if not yes else 0 for x, yes in zip(lean, labels) if x > 0) + sum(
                -x for x, yes in zip(lean, labels) if x < 0 and yes) + sum(w for a, b, w in edges if labels[a] != labels[b])

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(cut(lean, edges)) - best) < 1e-6


def test_whole_table(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.QUERIES["op1_html"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = [re.sub(r"<[^>]*>", "", x) for x in re.split(r"</?(?:p|h1|div|article)[^>]*>|<br>", article)]
        want = [" ".join(html.unescape(x).split()) for x in parts]
        assert r.text == "\n".join(x for x in want if x)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_broken_markup_and_empty_pages():
    for page in (None, "", "<", "<!-- open", "<p", "<script>", "</p></div>", "<b><i></b></i>", "a < b and c > d", "<a href='x>y", "\x00"):
        assert isinstance(main_text(page), str)
    assert [b.text for b in blocks("<p>a<p>b<div>c</p>d")] == ["a", "b", "c", "d"]
    assert [b.text for b in blocks("<table><tr><td>a<td>b<tr><td>c</table>")] == ["a", "b", "c"]
    assert [b.text for b in blocks("x<textarea><p>no</textarea> y &#x41;&eacute;")] == ["x y Aé"]
    many = "<article>" + "<p>word, word and word.</p>" * 5000 + "</article>" + "<nav>" + "<a>x</a>" * 5000 + "</nav>"
    assert main_text(many).count("\n") == 4999
    assert len(blocks("<div>" * 3000 + "deep")) == 1


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, "z"), (2, "u", "", "z"), (None, "u", PAGE, "z"), (3, "u", PAGE, "z"), (3, "u", PAGE, "z")],
                               "page_id long, url string, html string, text string")
    rows = extract(df).collect()
    assert sorted(r.n_chars > 0 for r in rows) == [False, False, True, True, True]
    assert extract(df.limit(0)).count() == 0


def test_names_inside_other_attributes_do_not_count():
    said = "This is a sentence with enough words in it, so that it is kept as the text of a page."
    for attrs in ['style="overflow:hidden"', "style='overflow: hidden'", 'title="The hidden gem"', 'data-hidden="false"',
                  "data-url=/a-hidden/lake", 'title="see id=sidebar here"', 'data-id="sidebar"', 'data-role="navigation"',
                  'aria-hidden="false"', 'title = "a > b hidden" lang=en', 'class="post"data-class="ad"', 'class=post class=ad']:
        for page in (f"<body {attrs}><article><p>{said}</p></article></body>", f"<article {attrs}><p>{said}</p></article>",
                     f"<article><p {attrs}>{said}</p></article>"):
            assert main_text(page) == said, page
    assert main_text(f'<article><p><a href="/a-hidden-lake">{said}</a> {said}</p></article>') == f"{said} {said}"
    for attrs in ["hidden", 'title="x" HIDDEN', "hidden=''", 'aria-hidden="true"', "aria-hidden = true", 'class="ad"hidden',
                  'title="x"id=sidebar', 'role="navigation"', "class = 'x ad'"]:
        assert main_text(f"<article><div {attrs}><p>{said}</p></div></article>") == "", attrs


SAID = "This is a sentence with enough words in it, so that it is kept as the text of a page."
ARTICLE = "".join(f"<p>{SAID}</p>" for _ in range(4))
KEPT = "\n".join([SAID] * 4)


def test_names_of_frames_and_of_properties_lose_no_article():
    for before, after in [
            ('<div class="content-sidebar-wrap"><article>', "</article></div>"),
            ('<div class="layout has-sidebar"><main>', "</main></div>"),
            ('<article class="post type-post category-social">', "</article>"), ('<article class="post comments-open">', "</article>"),
            ('<article class="post tag-legal">', "</article>"), ('<div class="no-ads"><article>', "</article></div>"),
            ('<form id="aspnetForm"><div><article>', "</article></div></form>"),
            ('<div id="page" class="sidebar-right"><div><article>', "</article></div></div>"),
            ('<div class="site-header-fixed"><main>', "</main></div>"),
            ('<div class="with-comments"><div class="post">', "</div></div>")]:
        page = f"<body><nav><a href='/'>Home</a></nav>{before}<h1>A title of it</h1>{ARTICLE}{after}<footer>End of it.</footer></body>"
        assert main_text(page) == "A title of it\n" + KEPT, before


def test_boilerplate_still_goes():
    for box in ['<section class="comments">', '<div id="comments"><ol><li class="comment"><article class="comment-body">',
                '<section><h3>3 Comments</h3>', '<div><h2>Leave a reply</h2>', '<div class="ad">', '<div class="widget social">', "<form>",
                "<aside><article>", '<div style="color:red; display : none">', '<div class="related-posts"><article>', '<div role="navigation">',
                '<div class="sidebar"><div><div><div><div><div><div><div>', "<header><div>", '<div class="cookie-notice">']:
        page = f"<body><main>{ARTICLE}</main>{box}<p>{SAID}</p><p>{SAID}</p></body>"
        assert main_text(page) == KEPT, box
    inside = f'<article>{ARTICLE}<div class="promo"><p>{SAID}</p></div><form><p>{SAID}</p></form></article>'
    assert main_text(inside) == KEPT


def test_broken_markup_takes_time_in_proportion():
    import time
    for piece in ("<a b='", '<a b="', "<![CDATA[", "<!--x", "</i>", "<a '>'", "<a '>\"", "<", "</", "<p", "<b>x", "<li><b>", "<div>x", "<b></i>"):
        page = piece * (1_000_000 // len(piece))
        started = time.perf_counter()
        main_text("<b>" * 20_000 + page)
        assert time.perf_counter() - started < 8, piece


def test_broken_markup_keeps_its_text():
    assert [b.text for b in blocks("<p>one<a b='<p>two</p>three")] != []
    assert [b.text for b in blocks("<p title='a>b'>x</p><p title=\"a'>y</p>")] == ["x", "y"]
    assert [b.text for b in blocks("a<!-- x > y -->b<!bad>c<?php x ?>d</>e")][0].startswith("abcd")
