"""Text of the article that names, lists, formulas and headers must not take away."""

from __future__ import annotations

import pytest

from surfacekit.llm.html_text import main_text

LONG = "A paragraph of the article, with commas, and more than enough words to be scored as the text of a page that one reads. "


def page(body, box="article"):
    return f"<html><head><title>T</title></head><body><nav><a href=/a>Home</a> <a href=/b>News</a></nav><{box}>{body}</{box.split()[0]}><footer>foot</footer></body></html>"


P1, P2 = f"<p>{LONG * 2}</p>", f"<p>{LONG * 3}</p>"
T1, T2 = (LONG * 2).strip(), (LONG * 3).strip()


@pytest.mark.parametrize("body, want", [
    (f'{P1}<pre><code>x = 1 <span class="hljs-comment"># the answer</span>\ny = 2</code></pre>{P2}', [T1, "x = 1 # the answer y = 2", T2]),
    (f'{P1}<p class="copyright-law">The law of copyright is old, and changes.</p>{P2}', [T1, "The law of copyright is old, and changes.", T2]),
    (f'{P1}<p class="share-buttons">Share this</p><p class="ad">Buy this</p>{P2}', [T1, T2]),
    (f'{P1}<ul><li><a href="/1">First source</a></li><li><a href="/2">Second source</a></li><li><a href="/3">Third source</a></li></ul>{P2}',
     [T1, "First source", "Second source", "Third source", T2]),
    (f'{P1}<ul class="menu"><li><a href="/1">One</a></li><li><a href="/2">Two</a></li><li><a href="/3">Three</a></li></ul>{P2}', [T1, T2]),
    (f'{P1}<p>We have <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation encoding="tex">x=1</annotation></math> and y.</p>{P2}', [T1, "We have x=1 and y.", T2]),
    (f'{P1}<p>A <em class="related">related</em> word and <a class="footer-link" href="/x">a link</a>.</p>{P2}', [T1, "A related word and a link.", T2]),
])
def test_article_text_is_kept(body, want):
    assert main_text(page(body)).split("\n") == want


def test_titles_outside_of_article_elements():
    assert main_text(page(f'<h1 class="page-header">The title</h1>{P1}{P2}', 'div class="content"')).split("\n") == ["The title", T1, T2]
    assert main_text(page(f"<header><h1>The title</h1></header>{P1}{P2}", "section")).split("\n") == ["The title", T1, T2]
    menu = "".join(f'<a href="/{k}">Entry {k}</a>' for k in range(6))
    assert main_text(page(f"<header><h1>Site</h1>{menu}</header>{P1}{P2}", "section")).split("\n") == [T1, T2]
