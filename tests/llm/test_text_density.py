"""Articles of made-up page layouts, of the given pages, edge cases."""

import re
import html

import pytest

from tallywise.llm import queries
from tallywise.llm import text_density as X

P1 = "The first paragraph of the article says a good deal about its subject, at some length and with care."
P2 = "A second one follows &amp; goes on; it is <b>bold</b> in <a href='/x'>places</a>, which is fine in prose."
P3 = "Short one."
PLAIN = [P1, "A second one follows & goes on; it is bold in places, which is fine in prose.", P3]
MENU = "<nav><ul>" + "".join(f"<li><a href='/{k}'>Menu item {k}</a></li>" for k in range(12)) + "</ul></nav>"
SIDE = "<div class='sidebar widget'><p>" + "Sidebar words that go on and on. " * 9 + "</p></div>"
COMMENTS = "<section id='comments'><p>" + "A reader says something rather long here. " * 12 + "</p></section>"
FOOT = "<footer><p>Imprint and other words about the site that nobody reads.</p></footer>"
ARTICLE = f"<h1>Head</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p>"
WANT = " ".join(["Head", *PLAIN])


@pytest.mark.parametrize("body", [
    f"<body><header><p>Site name</p></header>{MENU}<article>{ARTICLE}</article>{SIDE}{FOOT}</body>",
    f"<body>{MENU}<div id=content><div>{ARTICLE}</div></div>{SIDE}{COMMENTS}{FOOT}</body>",
    f"<body>{MENU}<main>{ARTICLE}<form><label>Name</label><input></form></main>{COMMENTS}</body>",
    f"<body>{MENU}<div class=post><h1>Head</h1><p>{P1}<p>{P2}<div class='ad'>Buy now</div><p>{P3}</div>{SIDE}",
    f"<div class='cookie-notice'>We use cookies.</div><article><header><h1>Head</h1></header><p>{P1}</p>"
    f"<script>var a='</p>';</script><p>{P2}</p><!-- x --><style>p{{}}</style>{P3}<aside>More</aside></article>",
    f"<body>{MENU}<div><section><h1>Head</h1><p>{P1}</p></section><section><p>{P2}</p><p>{P3}</p></section></div>{FOOT}",
])
def test_layouts(body):
    assert X.extract(f"<!DOCTYPE html><html><head><title>T</title></head>{body}</html>") == WANT


def test_blocks_and_inline():
    assert X.extract("<p>a<b>b</b>\n\t c&nbsp;d<br>e</p>f&lt;g&#233;") == "ab c d e f<gé"
    assert X.extract("<ul><li>one<li>two</ul>") == "one two"


def test_given_pages(spark, folder):
    """In these pages the article element holds exactly the text, unclosed paragraphs included."""
    want = {}
    for r in spark.read.parquet(f"{folder}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r.html, re.S)[1]
        inner = re.sub(r"</?(?:p|br|h1)>", "\n", inner)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b))).strip() for b in inner.split("\n")]
        want[r.page_id] = " ".join(b for b in blocks if b)
    got = queries.op9_text_density_extraction(spark, folder).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_edges(spark):
    deep = "<div>" * 20000 + "deep words" + "</div>" * 20000
    rows = [(1, None, "x"), (1, "", "x"), (None, "just words", "x"), (2, "<p>" + "long " * 200000, "x"),
            (3, "<article><p>cut off <a href='", "x"), (4, deep, "x"), (5, "<nav>menu</nav>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, main_text string")
    got = [r.main_text for r in X.with_main_text(pages).collect()]
    assert got[:3] == ["", "", "just words"] and len(got[3]) == 999_999
    assert got[4:] == ["cut off", "deep words", ""]
    assert X.with_main_text(pages.limit(0)).count() == 0


def text_of(spark, page):
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    return X.with_main_text(df).first().main_text


def test_quotes_only_open_after_an_equals_sign(spark):
    page = '<body><p class=x">First paragraph of the text stands here.</p><p class="y">The second one follows it.</p></body>'
    assert text_of(spark, page) == "First paragraph of the text stands here. The second one follows it."


def test_time_of_unclosed_markup():
    import time
    for page in ("<b>" * 30_000 + "<p>a" * 30_000, "<svg>" + "<g>" * 40_000, "<b>" * 30_000 + "</i>" * 30_000,
                 '<p>a <div ="' * 20_000, "<ul>" + "<li>x" * 40_000):
        start = time.perf_counter()
        X.parse(page)
        assert time.perf_counter() - start < 5


def test_a_name_does_not_hide_most_of_the_text(spark):
    words = "Plain sentences of an article, of which there are many more than of anything else. " * 20
    page = (f'<body><div class="search"><p>{words}</p><p>{words}</p></div><div class="footer">'
            f'{"<a href=x>link</a> and some small print of the house. " * 30}</div></body>')
    found = text_of(spark, page)
    assert words.strip() in found and "small print" not in found
