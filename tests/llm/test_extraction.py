"""Whole texts of pages with the weights that the registered query fits."""

import collections
import html
import re

import numpy as np
import pytest

from brindle.llm import html_extract

TEXT = "This article has some plain words of its own, and they go on for a good while before they end."
MORE = "The second half of this article has other words, and they go on for as long as those of the first."


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")


@pytest.fixture(scope="module")
def weights(pages):
    return html_extract.fit_weights(pages)


def article(page):
    """The article of a page of the tables: its blocks, without tags, as text."""
    inside = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p)>", re.sub("<br>", " ", inside))
    lines = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_whole_articles_of_the_tables(pages, weights):
    assert weights != html_extract.Weights()
    shares = []
    for r in pages.collect():
        whole = article(r["html"])
        assert html_extract.extract(r["html"], weights) == whole
        bare = html_extract.extract(re.sub(r"</?article\b[^>]*>", "", r["html"]), weights)
        one, two = collections.Counter(bare.split()), collections.Counter(whole.split())
        shares.append(2 * sum((one & two).values()) / max(1, sum(one.values()) + sum(two.values())))
    assert np.mean(shares) > 0.98


@pytest.mark.parametrize("start", ["<article>", "<div>"])
def test_links_in_paragraphs_are_text(weights, start):
    end = start.replace("<", "</")
    last = "<p>See <a href=1>the full long list of all related documents here</a></p>"
    got = html_extract.extract(f"<body><nav><a href=0>Home</a> <a href=1>News</a></nav>{start}<p>{TEXT}</p>{last}{end}<footer>foot</footer></body>", weights)
    assert got == f"{TEXT}\nSee the full long list of all related documents here"
    menu = "<div><ul><li><a href=0>Home page</a></li><li><a href=1>All the news</a></li></ul></div>"
    assert html_extract.extract(f"<body>{menu}<div><p>{TEXT}</p></div>{menu}</body>", weights) == TEXT
    crumbs = "<div><a href=0>Home page</a> » <a href=1>All the news</a> | <a href=2>Of this very day</a></div>"
    assert html_extract.extract(f"<body>{crumbs}<hr><div><p>{TEXT}</p></div></body>", weights) == TEXT


@pytest.mark.parametrize("n", [20, 40, 400])
def test_layout_without_words_ends_no_text(weights, n):
    for empty in ("<div><span></span></div>", "<div> </div>\n", "<table><tr><td></td></tr></table>"):
        assert html_extract.extract(f"<body><div><p>{TEXT}</p>{empty * n}<p>{MORE}</p></div></body>", weights) == f"{TEXT}\n{MORE}"


@pytest.mark.parametrize("inner", ["<section class=discussion><h3>Comments</h3><p>I like it very much indeed</p></section>", "<p class=cookie-notice>We use cookies on this site.</p>", "<p class='notice'>This site moves soon.</p>", "<span class=share>Share this with friends</span>", "<p class='ad'>Buy now</p>", "<div class='newsletter-signup'><p>Get our letter every week</p></div>"])
def test_notes_inside_articles_go(weights, inner):
    for w in (weights, html_extract.Weights()):
        assert html_extract.extract(f"<body><article><p>{TEXT}</p>{inner}<p>{MORE}</p></article></body>", w) == f"{TEXT}\n{MORE}"
        for name in ("legal", "reply", "meta", "tags", "related-work", "no-comments", "commentary"):
            assert html_extract.extract(f"<body><article><p>{TEXT}</p><p class={name}>{MORE}</p></article></body>", w) == f"{TEXT}\n{MORE}"
