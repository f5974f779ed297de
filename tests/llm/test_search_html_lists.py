from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from conftest import SF_MID, SF_SMALL
from surfacekit.llm import dated_lists, hamming_search, html_text, url_lists
from surfacekit.llm.common import table
from surfacekit.llm.queries import QUERIES

# --- nearest neighbours --------------------------------------------------------------------


def exact(ids, x, queries, k):
    out = {}
    for q in queries:
        mine = [(-float(x[j] @ x[ids.index(q)]), ids[j]) for j in range(len(ids)) if ids[j] != q]
        out[q] = [i for _, i in sorted(mine)[:k]]
    return out


def test_recall_against_brute_force(spark):
    rows = table(spark, SF_MID, "embeddings").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=float)
    got = {}
    for r in QUERIES["op1_hamming_search"](spark, SF_MID).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
        assert r["score"] == pytest.approx(x[ids.index(r["query_id"])] @ x[ids.index(r["vec_id"])], abs=1e-12)
    want = exact(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_copies_bad_vectors_and_small_tables(spark):
    rng = np.random.default_rng(3)
    same = [0.5, 0.5, -0.5, 0.5]
    rows = [(k, same) for k in range(0, 60)] + [(100 + k, (0.1 * rng.normal(size=4)).tolist()) for k in range(30)]
    bad = [(900, None), (901, []), (902, [0.0] * 4), (903, [1.0, None, 0.0, 0.0]), (904, [1.0, float("nan"), 0.0, 0.0]),
           (905, [float("inf"), 0.0, 0.0, 0.0]), (906, [1.0, 2.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows + bad], "vec_id long, embedding array<double>, score string")
    got = {}
    for r in hamming_search.nearest(df, df.where("vec_id % 20 = 0"), k=20, bits=8, recall=1.0, shard_size=7, query_block=2).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == {0, 20, 40, 100, 120}
    assert got[0] == list(range(1, 21)) and got[20] == list(range(20)) and got[40] == list(range(20))
    one = df.where("vec_id = 0")
    assert hamming_search.nearest(one, one).count() == 0
    assert hamming_search.nearest(df.limit(0), df.limit(0)).count() == 0
    assert [r["vec_id"] for r in hamming_search.nearest(df.where("vec_id in (0, 100)"), one).collect()] == [100]


def test_index_returns_every_code_within_the_radius():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 16))
    mean, rotation = hamming_search.learn_rotation(x, 24)
    for radius in (0, 3, 5, 9, 12):
        model = hamming_search.Codes(mean, rotation, hamming_search.share_radius(radius, 3))
        assert model.radius == radius
        index = hamming_search.MultiIndex(x, model)
        for q in range(0, 700, 70):
            far = np.bitwise_count(index.codes ^ index.codes[q]).sum(axis=1)
            assert index.within(index.codes[q]).tolist() == np.flatnonzero(far <= radius).tolist()


# --- HTML ----------------------------------------------------------------------------------

PAGES = [
    ("<p>Hello</p>", "Hello"), ("", ""), (None, ""), ("plain  text\nonly", "plain text only"), ('<a href="x', ""),
    ("<p>a<p>b<div>c", "a\nb\nc"),
    ("<body><header><h1>Site</h1></header><main><h1>T</h1><p>a<b>b</b> c &amp; d&#33;</p><ul><li>x<li>y</ul>"
     "<aside>no</aside><form><input>q</form></main><footer>f", "T\nab c & d!\nx\ny"),
    ('<div class="content"><p>One, two</p><div class="comments"><p>Nice, really, very nice post indeed, wow</p></div></div>'
     "<div class=sidebar><p>x</p></div>", "One, two"),
    ('<div id="page"><div id="header">H</div><div id="main-content"><h2>Title</h2><p>First para.</p><p>Second, para.</p></div>'
     '<div id="cookie-notice">We use cookies</div></div>', "Title\nFirst para.\nSecond, para."),
    ('<article><header class="post-header"><h1>Head</h1></header><p>Body<br>text</p><script>var t="</p>";</script>'
     "<style>p{}</style><!-- <p>no</p> --></article>", "Head\nBody text"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p role=alert>no</p><p>yes &lt;b&gt;</p></article>", "yes <b>"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("<article><p>İİİ<SCRIPT>x</SCRIPT> after</p></article><nav><p>" + "menu, " * 50 + "</p></nav>", "İİİ after"),
    ("<article><p>One long paragraph with <a href=x>a link</a> in it.</p><ul><li><a href=1>Home</a><li><a href=2>News</a>"
     "<li><a href=3>About us</a></ul><ul><li>see <a href=1>this</a> for more</ul></article>",
     "One long paragraph with a link in it.\nsee this for more"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_long_hostile_pages_end_soon():
    for html in ("<" * 200_000, "<a " * 50_000, "<!--" * 50_000, "&" * 100_000, "<p>" * 30_000 + "x", "</p>" * 50_000, '<a b="' * 30_000):
        html_text.main_text(html)


def test_every_page_is_extracted(spark):
    rows = [(k, f"u{k}", h, "x") for k, (h, _) in enumerate(PAGES)] + [(0, "u0", "<p>Hello</p>", "x"), (None, None, "<p>q</p>", "y")]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in out.collect()), key=str)
    want = [(k, t, len(t)) for k, (_, t) in enumerate(PAGES)] + [(0, "Hello", 5), (None, "q", 1)]
    assert got == sorted(want, key=str)
    pages = table(spark, SF_SMALL, "pages")
    whole = html_text.extract(pages).join(pages.select("page_id", "html"), "page_id")
    bad = whole.where("text = '' or contains(text, '<p>') or contains(text, 'track(')")
    assert whole.count() == pages.count() and bad.count() == 0
    assert html_text.extract(pages.limit(0)).count() == 0


# --- URL lists -----------------------------------------------------------------------------


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_lists_as_of_each_fetch(spark):
    entries = [("spam", "Example.com", "add", day(10)), ("spam", "example.com", "remove", day(20)), ("spam", "example.com", "add", day(30)),
               ("spam", "example.com", "add", day(32)), ("adult", "a.example.com", "add", day(0)), ("adult", "b.org", "add", day(5)),
               ("adult", "b.org", "remove", day(5)), (None, "b.org", "add", day(1)), ("x", None, "add", day(1)), ("x", "b.org", "add", None),
               ("x", "b.org", "keep", day(1)), ("y", "c.net", "remove", day(1)), ("spam", "example.com", "add", day(10))]
    lists = spark.createDataFrame([(*e, "q") for e in entries], "list string, pattern string, action string, on_date date, host string")
    cases = [("http://example.com/x", 9, ""), ("http://example.com/x", 10, "spam"), ("https://u:p@WWW.Example.com.:80/", 19, "spam"),
             ("http://example.com", 20, ""), ("http://a.example.com?q", 29, "adult"), ("http://a.example.com#f", 31, "adult,spam"),
             ("http://notexample.com/", 31, ""), ("http://b.org/", 6, ""), ("http://c.net", 9, ""), (None, 31, ""), ("nonsense", 31, ""),
             ("http://example.com/x", None, ""), ("http://example.com/x", 10, "spam"), ("http://" + "a." * 3000 + "example.com/", 40, "adult,spam")]
    rows = [(k, u, None if d is None else day(d), "x") for k, (u, d, _) in enumerate(cases)]
    out = url_lists.listed(spark.createDataFrame(rows, "page_id long, url string, fetched_on date, pattern string"), lists)
    got = {r["page_id"]: (r["lists"], r["n_lists"], r["blocked"]) for r in out.collect()}
    assert got == {k: (x, len([y for y in x.split(",") if y]), bool(x)) for k, (_, _, x) in enumerate(cases)}
    spans = {tuple(r) for r in url_lists.validity_intervals(lists).collect()}
    assert spans == {("spam", "example.com", day(10), day(20)), ("spam", "example.com", day(30), None), ("adult", "a.example.com", day(0), None)}
    assert url_lists.listed(out.select("page_id", "url", "fetched_on").limit(0), lists).count() == 0
    assert url_lists.listed(out.select("page_id", "url", "fetched_on"), lists.limit(0)).where("blocked").count() == 0


def test_registered_lists_equal_the_oracle(spark, duck):
    df = QUERIES["op7_url_lists"](spark, SF_SMALL)
    cur = duck.execute(dated_lists.ORACLE)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in df.select(names).collect())
