"""Main text over layouts with and without article, against a plain reading of the given pages, and on hostile pages."""

import html
import re
import time
import tracemalloc

import pytest

from kontora.llm.html_text import PRIOR, SHARE, Page, main_text, path_scores, tokens

P = "<p>A paragraph of the text, which is long enough, has marks and says something; all told.</p>"
T = "A paragraph of the text, which is long enough, has marks and says something; all told."
MENU = "<div><a href=1>Home</a> <a href=2>News</a></div>"

LAYOUTS = {
    "wrapper with a furniture word": (f"<div class='page has-sidebar'><article><h1>T</h1>{P}</article></div>", f"T {T}"),
    "wrapper of furniture words": (f"<div id='header-main-wrap'><article><h1>T</h1>{P}</article></div>", f"T {T}"),
    "slugs of titles": (
        f"<article><h2 id='related-work'>Related</h2><section id='search-methods'>{P}</section><p class='share-prices'>Prices rose.</p><section id=search>{P}</section></article>",
        f"Related {T} Prices rose. {T}",
    ),
    "title and lead beside the body": (f"<div id=content><h1>Title</h1><p>lead</p><div class=body>{P * 20}</div></div>", "Title lead " + " ".join([T] * 20)),
    "form around the page": (f"<body><form id=f>{MENU}<div><h1>Hi</h1>{P * 5}</div></form>", "Hi " + " ".join([T] * 5)),
    "table cells": (f"<table><tr><td class=nav><a href=1>x</a><td><h1>Tab</h1>{P * 4}</table>", "Tab " + " ".join([T] * 4)),
    "straight in the body": (f"<body><div>Site</div>{MENU}<h1>Head</h1>{P * 4}<div>&copy; X</div>", "Head " + " ".join([T] * 4)),
    "lists, quotes, code between": (
        f"<div><div class=menu><a href=1>x</a></div><div class=post>{P}<ul><li>one<li>two</ul>{P}<pre>x = 1</pre><blockquote>Said.</blockquote>{P}</div></div>", f"{T} one two {T} x = 1 Said. {T}",
    ),
    "readers' comments": (f"<article>{P}<div class='comment-list'><article>{P}</article></div></article>", T),
    "comments without an article": (f"<div class=post>{P}</div><section id=comments>{P * 9}</section>", T),
    "related articles": (f"<article>{P}</article><div class='related-posts'><article>{P}</article></div>", T),
    "notices and adverts": (f"<main><div class='cookie-notice'>{P}</div>{P}<div class=ad>{P}</div><aside>{P}</aside></main><footer>{P}</footer>", T),
    "open head": (f"<html><head><title>t</title><div>{P}</div>", T),
    "raw text": (f"<article><script>if (a<b) '</p>'</script><style>p>a{{}}</style>{P}<noscript><p>no</p></noscript></article>", T),
    "attributes": (f"<article><p title='a > b' data-x=\"<p>\">One.</p>{P}<a =x y='>'>link</a></article>", f"One. {T} link"),
    "class in another attribute": (f"<article><div data-class='ad' title=\"class=ad\">{P}</div></article>", T),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page, want = LAYOUTS[name]
    assert main_text(page) == want


def plain_article(page):
    """The article of the given pages, which have one layout, by patterns."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    body = re.sub(r"</?(?:b|i|em|a|span|strong)(?: [^>]*)?>", "", body)
    return " ".join(html.unescape(re.sub(r"<[a-z/!][^>]*>", " ", body)).split())


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(pages) > 100 and all(main_text(r.html) == plain_article(r.html) for r in pages)


def test_given_pages_without_article_tags(spark):
    """The paths alone find the same text: article becomes a div like any other."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    hits = sum(main_text(p.replace("<article>", "<div>").replace("</article>", "</div>")) == plain_article(p) for p in pages)
    assert hits >= 0.95 * len(pages)


def test_scores_are_those_of_the_definition():
    """Ratios by path, smoothed by a quarter of either neighbour, fused; an article's are raised."""
    tree = Page(f"<div>{P}{P}<h2>Short</h2></div><ul><li><a href=1>link, link</a></ul>")
    got = path_scores(tree.nodes, tree.paths, [False] * len(tree.tags))
    size, marks = len(T), 4
    raw = [(size, marks), (size, marks), (5, 0), (0, 0)]
    smooth = [tuple(0.25 * raw[max(0, k - 1)][c] + 0.5 * raw[k][c] + 0.25 * raw[min(3, k + 1)][c] for c in (0, 1)) for k in range(4)]
    want = [max(smooth[k][0] * (1 + smooth[k][1]) for k in (0, 1)), smooth[2][0] * (1 + smooth[2][1]), 0.0]
    assert [got[tree.paths[n[0]]] for n in tree.nodes[1:]] == pytest.approx(want)
    raised = path_scores(tree.nodes, tree.paths, [True] * len(tree.tags))
    assert all(raised[k] == pytest.approx(PRIOR * v) for k, v in got.items()) and 0 < SHARE < 1


def test_tokens():
    assert [t[:2] for t in tokens("a<B x='>'>c</b><!-- < --><!doctype x>5 < 6<br/>")] == [
        ("text", ""), ("open", "b"), ("text", ""), ("close", "b"), ("text", ""), ("text", ""), ("text", ""), ("open", "br"),
    ]
    assert list(tokens("<script>a</SCRIPT >b")) == [("open", "script", ""), ("close", "script", ""), ("close", "script", ""), ("text", "", "b")]
    assert "".join(t[2] for t in tokens("x <a 'never closed")) == "x <a 'never closed"


HOSTILE = {
    "nested": "<div>" * 200_000 + "x", "nested with text": "<div>a. " * 125_000, "quotes": '<a "' * 250_000, "open scripts": "<script " * 125_000,
    "open scripts that end": "<script " * 125_000 + ">", "signs": "<" * 1_000_000, "headings in selects": "<p><select>" + "<x>" * 100_000 + "<h1>" * 150_000,
    "closing tags": "</x>" * 250_000, "open comments": "<!--" * 250_000, "mixed quotes": "<a b='\">" * 125_000, "attributes": "<a " + "class=" * 200_000 + ">",
    "items": "<li>" * 250_000, "spaces": "<div class" + " " * 1_000_000 + ">x", "classes": "<div class='" + "ad-" * 300_000 + "'>x",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_pages_end(name):
    tracemalloc.start()
    began = time.process_time()
    main_text(HOSTILE[name])
    took, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 20 and peak < 500 << 20
