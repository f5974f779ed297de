from __future__ import annotations

import pytest

from surfacekit.llm import html_text

TEXT = "A paragraph, with some words, that belongs to the article of the page."
SIDE = '<div class="sidebar"><p>Side text.</p></div>'

OPEN_HEADS = [
    f"<head><title>T</title><body><p>{TEXT}</p>",
    f"<html><head><meta charset=utf-8><title>T</title><body class=x><p>{TEXT}</p></body></html>",
    f"<head><title>T</title><link rel=x href=y><div><p>{TEXT}</p></div>",
    f"<head><script>x</script>{TEXT}",
    f"<head><title>T</title></head><body><p>{TEXT}</p>",
]

WRAPPERS = [
    f'<body><div class="wrapper has-sidebar"><div class="col"><p>{TEXT}</p></div>{SIDE}</div></body>',
    f'<body><div id="container" class="no-comments"><p>{TEXT}</p></div></body>',
    f'<body><div class="hasSidebar"><p>{TEXT}</p></div></body>',
    f'<body><div class="container sidebar-left"><p>{TEXT}</p>{SIDE}</div><p>c 2024</p></body>',
    f'<body><div class="layout-sidebar"><article><p>{TEXT}</p></article>{SIDE}</div></body>',
    f'<body><div class="sidebar-right"><div class="menu-left"><p>{TEXT}</p></div></div></body>',
    f'<nav>{"menu " * 90}</nav><div class="x sidebar-right"><div class="main"><p>{TEXT}</p></div></div>',
]

PARTS = [
    '<div class="content"><p>One, two</p><div class="comments"><p>Nice, really, very nice post indeed, wow</p></div></div>',
    f'<div id="content"><p>One, two</p></div><div id="comments"><div class="text"><p>{TEXT}</p></div></div>',
    f'<article><p>One, two</p><div class="share-container"><p>{TEXT}</p></div></article>',
]


@pytest.mark.parametrize("html", OPEN_HEADS)
def test_a_head_without_its_end_holds_no_text(html):
    assert html_text.main_text(html) == TEXT


@pytest.mark.parametrize("html", WRAPPERS)
def test_wrappers_with_a_word_of_the_layout_stay(html):
    assert html_text.main_text(html).split("\n")[0] == TEXT and "Side text" not in html_text.main_text(html)


@pytest.mark.parametrize("html", PARTS)
def test_parts_beside_an_article_still_go(html):
    assert html_text.main_text(html) == "One, two"


LONG = "<p>" + "A longer paragraph, with commas, of the article. " * 4 + "</p>"
LINES = " ".join(("A longer paragraph, with commas, of the article. " * 4).split())
SECTIONS = [
    (f"<article><section>{LONG * 20}</section><section><p>Short one.</p></section></article>", [LINES] * 20 + ["Short one."]),
    (f"<main><section>{LONG * 20}</section><ul><li>x<li>y</ul><table><tr><td>c</table><blockquote>Quote</blockquote><pre>code</pre>"
     "<div>Plain</div></main>", [LINES] * 20 + ["x", "y", "c", "Quote", "code", "Plain"]),
    (f"<div id=a><div><div>{LONG * 20}</div></div><div><div><p>Short one.</p></div></div></div>", [LINES] * 20 + ["Short one."]),
    (f"<body>Loose text<div>{LONG * 20}</div><blockquote>Quote</blockquote><ul><li>x</ul>"
     "<p><a href=1>Home</a> | <a href=2>News</a></p></body>", ["Loose text"] + [LINES] * 20 + ["Quote", "x"]),
    (f"<body><div><p><a href=1>Some link text of the site</a></p></div><article><section>{LONG * 20}</section><p>End.</p></article></body>",
     [LINES] * 20 + ["End."]),
]


@pytest.mark.parametrize("html, lines", SECTIONS)
def test_parts_beside_the_best_section_stay(html, lines):
    assert html_text.main_text(html).split("\n") == lines
