import html
import re
import time
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civicspark.llm import html_text as H


def test_what_goes_and_what_stays():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x</article>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
    <div id="cookie-notice">We use cookies and cookies and more cookies for a long long while.</div>
    <article><header><h1>Head &amp; line</h1></header><p><b>First
    paragraph &lt;here&gt;, a good deal of text in it.<br>Next<p>Short.</p><script>track()</script><aside>Aside</aside>
    <form><input value=q>Search</form><ul><li>One<li>Two</ul><blockquote>Quoted &#233;&nbsp;text</blockquote>
    <section class="comments"><p>Reader says hello in a long comment that goes on.</p></section></article>
    <div class="sidebar">Other</div><footer>&copy; me</footer></body></html>"""
    assert H.main_text(page).split("\n\n") == ["Head & line", "First paragraph <here>, a good deal of text in it. Next", "Short.", "One", "Two", "Quoted é text"]


def test_without_an_article_the_ratio_chooses():
    links = "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(12))
    page = f"<body><div><ul>{links}</ul></div><div id=x><h2>Title</h2><p>{'long text ' * 30}</p><p>{'more text ' * 30}</p><p>End.</p></div><div><a href=q>imprint</a></div></body>"
    assert H.main_text(page).split("\n\n") == ["Title", ("long text " * 30).strip(), ("more text " * 30).strip(), "End."]


def test_odd_pages():
    for page in (None, "", "<", "<!--", "<nav>only a menu</nav>", "<script>x", "<p></p>", "   "):
        assert H.main_text(page) in ("", "<", "<!--")
    assert H.main_text("just  plain\ntext") == "just plain text"
    assert H.main_text("<p>unclosed <b>bold <i>text") == "unclosed bold text"
    assert H.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert H.main_text("</p></div>stray ends") == "stray ends"
    assert H.main_text("<article><p>x</p></article>") == "x"


def test_malformed_declarations():
    for odd in ("<![foo x]>", "<![CDATA[x]]>", "<![if !IE]>", "<!DOCTYPE [<!ENTITY a 'b'>]>", "<!ELEMENT br EMPTY>", "<!>", "<!-x->", "<?php x ?>", "</>", "<!["):
        assert H.main_text(f"<p>a</p>{odd}<p>b</p>").startswith("a")
    assert H.main_text("<p>a</p><![foo x]>b") == "a\n\nb"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "</", "<!", "<![", "]]>", "--", "<!--", "<?", "&", "&#", "&#x110000;", "div", "p", "article", " class='ad'", "form", "table", "td", "a", "=", '"', "'", "/", "\x00", "text", "\n", "script", "é", "[", "]"]), max_size=40).map("".join))
def test_no_page_fails(page):
    assert isinstance(H.main_text(page), str)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=200))
def test_random_bytes(data):
    assert isinstance(H.main_text(data.decode("latin-1")), str)


@pytest.mark.parametrize("tag", ["div", "article", "b", "table", "form", "a", "p", "ul"])
def test_deep_nesting_costs_no_more_than_its_length(tag):
    n = 100_000
    tracemalloc.start()
    start = time.process_time()
    text = H.main_text(f"<{tag}>" * n + "deep <p>text" + "</b>" * n)
    assert ("deep" in text) == (tag != "form") and time.process_time() - start < 30
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_without_an_article_nothing_of_the_container_is_lost():
    cells = "<table><tr><td>Short</td><td><a href=x>linked cell</a></td></tr></table>"
    body = "".join(f"<div><p>{'a long paragraph of text ' * 9}{i}</p></div>" for i in range(4))
    page = f"<body><div><a href=1>one</a><a href=2>two</a></div><div id=x><h2><a href=y>A linked heading</a></h2>{body}<section>Tiny.</section>{cells}</div></body>"
    got = H.main_text(page).split("\n\n")
    assert [got[0], *got[-3:]] == ["A linked heading", "Tiny.", "Short", "linked cell"] and len(got) == 8


def test_a_very_long_page_is_read_whole():
    body = "".join(f"<p>Paragraph {i} has some text.</p>" for i in range(20000))
    assert H.main_text(f"<nav>m</nav><article>{body}</article><footer>f</footer>").count("\n\n") == 19999


def plain(page):
    """The pages' own layout: headings and paragraphs of the one article."""
    inside = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)\b[^>]*>", inside))
    return "\n\n".join(x for x in blocks if x)


def test_pages_equal_their_articles(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: r for r in H.extract(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == plain(r["html"]) and got[r["page_id"]]["n_chars"] == len(plain(r["html"]))


def test_rows_pass_as_they_are(spark):
    rows = [(1, "u", "<p>a</p>", "t"), (1, "u", "<p>a</p>", "t"), (None, None, None, None), (2, None, "", "t")]
    out = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (2, None, "", 0)], key=repr)
    assert H.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
