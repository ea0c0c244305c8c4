"""Names of layouts, title blocks and sections that only look like notices; elements closed by a slash."""

import pytest

from tallywise.llm import text_density as X
from test_text_density import ARTICLE, COMMENTS, FOOT, MENU, P1, P2, PLAIN, SIDE, WANT  # noqa: I001


@pytest.mark.parametrize("names", [
    "content has-sidebar", "layout no-sidebar", "page-wrapper with-sidebar", "single-post comments-closed",
    "related", "sidebar widget"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<div>{}</div>"])
def test_wrappers_keep_the_article(names, inner):
    body = inner.format(ARTICLE)
    assert X.extract(f"<body>{MENU}<div class='{names}'>{body}</div>{FOOT}</body>") == WANT


@pytest.mark.parametrize("name", ["entry-header", "section-header", "related-work", "discussion-of-results"])
def test_parts_of_the_article_stay(name):
    page = f"<body>{MENU}<article><div class='{name}'><h1>Head</h1></div><p>{P1}</p><p>{P2}</p></article>{SIDE}"
    assert X.extract(page) == " ".join(["Head", *PLAIN[:2]])


@pytest.mark.parametrize("name", ["comments", "comment-list", "sidebar widget", "cookie-notice", "nav-links"])
def test_notices_go(name):
    page = f"<body><div>{ARTICLE}<div class='{name}'><p>Something else.</p></div></div>{COMMENTS}{FOOT}"
    assert X.extract(page) == WANT


def test_captions_and_formulas_stay():
    page = f"<article><p>{P1}</p><figure><figcaption>A caption.</figcaption></figure><p>x <math><mi>y</mi></math></p>"
    assert X.extract(page) == f"{P1} A caption. x y"


@pytest.mark.parametrize("odd", ["<svg width=1 />", "<math/>", "<svg><text>no</text></svg>", "<canvas>no</canvas>",
                                 "<svg><path d=x>", "<math><mi>"])
def test_embedded_elements_end_where_they_end(odd):
    assert X.extract(f"<body>{MENU}<article><p>{P1}</p>{odd}<p>{P2}</p></article>") == " ".join(PLAIN[:2])
