"""The pipeline's stages go by rows: equal ids, null ids, clashing names, empty tables."""

from __future__ import annotations

import corpus_pipeline as P
import pytest
from helpers import documents, prose, repeated

from conftest import SF_SMALL
from surfacekit.llm.common import table
from surfacekit.llm.decontaminate import Matcher

CLASH = "n_words n_removed kept_sha256 score predicted held_out component_id n_shingles item_id row class"


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES[:-1]])
def test_empty_tables_and_clashing_columns(spark, stage):
    empty = documents(spark, [], CLASH)
    assert stage(spark, empty, SF_SMALL).columns == empty.columns and stage(spark, empty, SF_SMALL).count() == 0
    passage = prose(1, 60)
    docs = documents(spark, [(1, f"{prose(2, 80)} {passage} tail"), (2, f"head {passage} {prose(3, 90)}"), (3, None), (4, "")], CLASH)
    out = stage(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    assert all(r[c] == "x" for r in out.collect() for c in CLASH.split())


def test_packing_of_edges(spark):
    assert P.packed(spark, documents(spark, [], CLASH), SF_SMALL).count() == 0
    out = P.packed(spark, documents(spark, [(1, None), (1, ""), (None, "a b"), (2, "a b"), (2, "a b")], CLASH), SF_SMALL).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in out) == [("1", 1), ("1", 1), ("2", 3), ("2", 3), ("None", 3)]


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    item = table(spark, SF_SMALL, "benchmark").first()["text"]
    good, bad = prose(5, 120), f"{prose(6, 60)} {item} {prose(7, 60)}"
    docs = documents(spark, [(1, good), (1, bad), (None, bad), (None, good), (2, bad), (2, bad)])
    assert rows(P.without_benchmark(spark, docs, SF_SMALL)) == sorted([(1, good), (None, good)], key=str)
    docs = documents(spark, [(1, good), (1, bad), (2, good), (None, bad), (None, bad), (3, None), (3, None), (4, "")])
    assert rows(P.one_of_each_group(spark, docs, SF_SMALL)) == sorted([(1, good), (1, bad), (3, None), (3, None), (4, "")], key=str)
    null = documents(spark, [(None, good), (None, good), (None, bad)])
    assert rows(P.one_of_each_group(spark, null, SF_SMALL)) == sorted([(None, good), (None, bad)], key=str)


def test_quality_goes_by_the_text(spark):
    given = table(spark, SF_SMALL, "documents")
    kept = {r["doc_id"] for r in P.keep_quality(spark, given, SF_SMALL).collect()}
    good, bad = (given.where(given.doc_id.isin(list(kept)) if x else ~given.doc_id.isin(list(kept))).select("text").first()[0] for x in (1, 0))
    extra = documents(spark, [(-1, good), (-1, bad), (None, bad), (None, good)]).select(given.columns)
    out = [r for r in rows(P.keep_quality(spark, given.unionByName(extra), SF_SMALL)) if r[0] in (-1, None)]
    assert out == sorted([(-1, good), (None, good)], key=str)


def test_repeats_in_many_texts_with_shared_chains(spark):
    """Passages of many segments in a row, some side by side, at the start, at the end and alone."""
    a, b, c = prose(11, 400, 3000), prose(12, 90, 3000), prose(13, 75, 3000)
    texts = [a, f"{prose(20, 30, 9999)} {a} {prose(21, 30, 9999)}", f"{a} {b}", f"{b} {a} {c}", f"{prose(22, 200, 9999)} {c}", c, f"{b} {b}", prose(23, 300, 9999), None, "",
             *[f"{prose(30 + k, 5 + k, 9999)} {b} {prose(60 + k, 9, 9999)}" for k in range(20)], a, a]
    docs = documents(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r["text"] for r in P.without_repeats(spark, docs, SF_SMALL).collect()}
    want = {i: (k.decode() if n else texts[i]) for i, _, n, k in repeated(list(enumerate(texts)), 50)}
    assert got == want


def test_short_items_match_as_words(spark):
    matcher = Matcher([(1, "no"), (2, "c++"), (3, "42")], 0.08)
    found = lambda t: sorted(x[0] for x in matcher.search(t))
    assert found("nothing known 1423 c+") == []
    assert found("he said no.") == [1] and found("nothing, no") == [1]
    assert found("xc++y (c++) is 42") == [2, 3]
    assert list(matcher.search("nono no")) == [(1, 0, 5, 7)]
