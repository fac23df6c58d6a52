import re
import time
from html import unescape

import pandas as pd
import pytest

from carelattice.llm import html_blocks, queries

PROSE = "The quick fox is in the garden of the house and it was not the only one that came by."
MORE = "And this is the second paragraph of the article, with a link to the source of the story."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><body></body></html>", ""),
    (f"<p>{PROSE}</p>", PROSE),
    (f"<nav><a href='/'>Home</a></nav><h1>Title</h1><p>{PROSE}</p><footer>&copy; us</footer>", f"Title\n\n{PROSE}"),
    (f"<header><h1>Site</h1></header><article><header><h1>T &amp; U</h1></header><p>{PROSE}<p>Short.</article>",
     f"T & U\n\n{PROSE}\n\nShort."),
    (f"<article><h1>T</h1><p>{PROSE}</p><div class='share-buttons'>Tell your friends of the story that is here, it is the "
     f"best of all.</div><section id='comments'><p>{MORE}</p></section></article>", f"T\n\n{PROSE}"),
    (f"<div class='cookie-notice'>{MORE}</div><main><p>{PROSE}</p></main><aside>{MORE}</aside>", PROSE),
    (f"<article><p>{PROSE}</p><form><p>{MORE}</p><input></form><p>{MORE}</p></article>", f"{PROSE}\n\n{MORE}"),
    ("<article><p>One</p><p>Two</p></article>", "One\n\nTwo"),
    (f"<script>var a='</p><p>{PROSE}';</script><style>p{{}}</style><p>{PROSE}</p><!-- <p>{MORE}</p> -->", PROSE),
    (f"<script>{PROSE}", ""), (f"<!-- {PROSE}", ""),
    ("<article><p>a\n\t b&nbsp;c<br>d <b>e</b>f &lt;g&gt; &#233;&eacute;</p></article>", "a b c d ef <g> éé"),
    (f"<article><ul><li>One of it</li><li>Two</li></ul><p title=\"a > b\">{PROSE}</p></article>",
     f"One of it\n\nTwo\n\n{PROSE}"),
    (f"<p>{PROSE}</p><p>Short end.</p><ul><li><a>More</a></li><li><a>Links</a></li></ul>", f"{PROSE}\n\nShort end."),
    (f"<article><p>{PROSE}</p><p hidden>{MORE}</p><p style='display: none'>{MORE}</p></article>", PROSE),
    (f"<article><p>{PROSE}</p><p>cut &am", f"{PROSE}\n\ncut &am"),
    (f"<article><p>{PROSE}</p><p>cut <a hre", f"{PROSE}\n\ncut"),
    (f"<div class='ad'>{MORE}</div><article><p>{PROSE}</p></article><div>{MORE}</div>", PROSE),
])
def test_pages(html, text):
    assert html_blocks.main_text(html) == text


def test_very_long_and_hostile_pages_end():
    page = "<article>" + f"<p>{PROSE}</p>" * 5_000 + "</article>"
    assert html_blocks.main_text(page) == "\n\n".join([PROSE] * 5_000)
    for broken in ("<" * 20_000, "<a " * 20_000, "<p title='" * 2_000, "</b>" * 20_000, "&" * 20_000, "<div>" * 3_000):
        assert isinstance(html_blocks.main_text(broken), str)


def test_given_pages(spark, sf_dir):
    """The given pages have one article of headings and paragraphs, and it comes out whole."""
    pages = pd.read_parquet(f"{sf_dir}/pages.parquet")
    got = queries.op6_html(spark, sf_dir).toPandas().merge(pages, on=["page_id", "url"])
    assert len(got) == len(pages)
    for html, text, n in zip(got.html, got.text, got.n_chars):
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(unescape(re.sub(r"</?\w[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert text == "\n\n".join(b for b in blocks if b) and n == len(text)


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>x"), (1, "u", "<p>x"), (None, None, None)],
                               "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = html_blocks.extract(df).collect()
    assert len(got) == 3 and {r["text"] for r in got} == {""} and got[0].asDict().keys() == {"page_id", "url", "text"}
    assert html_blocks.extract(df.limit(0)).collect() == []


POLISH = "Szybki lis siedzi w ogrodzie przy starym domu i patrzy na ludzi, którzy przechodzą obok niego."


@pytest.mark.parametrize("html, text", [
    ("<body><h1>Title</h1><p>Short paragraph.</p></body>", "Title\n\nShort paragraph."),
    (f"<nav><a href='/'>Start</a></nav><h1>Lis</h1><p>{POLISH}</p><p>Koniec.</p><footer>{POLISH}</footer>", f"Lis\n\n{POLISH}\n\nKoniec."),
    (f"<p>{POLISH}</p><ul><li><a href='/1'>Inne</a></li></ul><p>{POLISH}</p>", f"{POLISH}\n\n{POLISH}"),
    ("<p><a href='/'>Only a link</a></p><nav>Menu here</nav>", ""),
])
def test_pages_without_a_decided_block(html, text):
    assert html_blocks.main_text(html) == text


@pytest.mark.parametrize("html, text", [
    (f"<article><p><a href='/x'>See</a> <a name='top'>{PROSE}<p>{MORE}</article>", f"See {PROSE}\n\n{MORE}"),
    (f"<article><h2><a id='part'>Part</h2><p>{PROSE}</p></article>", f"Part\n\n{PROSE}"),
    (f"<article><p>{PROSE} <a href='/x'>more</p><p>{MORE}</p></article>", f"{PROSE} more\n\n{MORE}"),
    (f"<article><p>{PROSE} <a href='/x'>more<p>{MORE}</article>", f"{PROSE} more\n\n{MORE}"),
    (f"<article><p>{PROSE}</p><ul><li><a href='/x'>All of it<li>{MORE}</ul><p>{PROSE}</p></article>", f"{PROSE}\n\n{MORE}\n\n{PROSE}"),
    (f"<article><p>{PROSE}</p><a href='/x'><div>{MORE}</div><div>{MORE}</div></a><p>{MORE}</p></article>", f"{PROSE}\n\n{MORE}"),
])
def test_links_end(html, text):
    assert html_blocks.main_text(html) == text


WRAPPERS = ["layout has-sidebar", "with-sidebar", "side-by-side", "no-comments", "single-post share-on", "sidebar-layout", "share",
            "related-page", "widget-area main-widget", "promo", "header-on page"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_wrappers_do_not_swallow_the_article(name):
    side = f"<div class='sidebar'>{MORE}</div><section id='comments'><article><p>{MORE}</p></article></section>"
    page = f"<nav>Menu</nav><div class='{name}'><article><h1>T</h1><p>{PROSE}</p>{{}}</article></div>"
    assert html_blocks.main_text(page.format("")) == f"T\n\n{PROSE}"
    assert html_blocks.main_text(f"<body id='{name}'>" + page.format(side) + side) == f"T\n\n{PROSE}"
    plain = f"<nav>Menu</nav><div class='{name}'><h1>T</h1><p>{PROSE}</p><p>{PROSE}</p><div class='ad'>{MORE}</div></div>"
    assert html_blocks.main_text(plain) == f"T\n\n{PROSE}\n\n{PROSE}"


@pytest.mark.parametrize("head", ["post-header", "entry-header", "article_header", "header"])
def test_the_head_of_an_article_is_its_own(head):
    assert html_blocks.main_text(f"<article><div class='{head}'><h1>T</h1></div><p>{PROSE}</p></article>") == f"T\n\n{PROSE}"
    assert html_blocks.main_text(f"<header>Site</header><div class='page-header'>Site</div><p>{PROSE}</p>") == PROSE


def test_comments_stay_out_where_there_is_an_article():
    for kind in ("comments", "comment-list", "related posts", "newsletter-signup"):
        page = f"<article><p>{PROSE}</p></article><div class='{kind}'><article><p>{MORE}</p></article><p>{MORE}</p></div>"
        assert html_blocks.main_text(page) == PROSE
        assert html_blocks.main_text(f"<div><p>{PROSE}</p></div><div class='{kind}'>" + f"<p>{MORE}</p>" * 5 + "</div>") == PROSE


@pytest.mark.parametrize("name", "script style title textarea noscript template iframe xmp".split())
def test_cut_off_raw_elements_take_linear_time(name):
    begun = time.process_time()
    for attributes in (' data-x="v"' * 30, " data-x='v'" * 3_000, ' a="' * 3_000, " x='\"" * 3_000, ' a="v"' * 100_000):
        assert html_blocks.main_text(f"<p>{PROSE}</p><{name}{attributes}") == PROSE
        assert html_blocks.main_text(f"<p>{PROSE}</p><{name}{attributes}>text") == PROSE
    assert html_blocks.main_text(f"<p>{PROSE}</p><{name} a='x'/><p>{MORE}</p>") == f"{PROSE}\n\n{MORE}"
    assert time.process_time() - begun < 5
