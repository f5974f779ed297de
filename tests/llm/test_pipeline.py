from __future__ import annotations

import corpus_pipeline
import pytest
from helpers import documents, groups, repeated

import __spark_entry__ as entry
from conftest import SF_SMALL
from surfacekit.llm.common import stored, table
from surfacekit.llm.decontaminate import normal
from surfacekit.llm.packing import WordTokenizer
from surfacekit.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_SMALL, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, stored(stage(spark, docs, SF_SMALL))))
        docs = out[-1][1]
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stage_columns_are_those_of_documents(stages, spark):
    names = table(spark, SF_SMALL, "documents").columns
    assert [df.columns for _, df in stages[:-1]] == [names] * 4
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "packing"]


def test_quality_stage_drops_what_the_classifier_rejects(stages, spark):
    before, after = stages[0]
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op9_quality"](spark, SF_SMALL).collect()}
    assert sorted(rows(after)) == sorted(r for r in rows(before) if scores[r[0]] == 1)
    good = {r["doc_id"] for r in table(spark, SF_SMALL, "labels").where("quality = 1").collect()}
    assert len(good - {i for i, _ in rows(after)}) <= 0.02 * len(good)


def test_join_stage_keeps_the_least_document_of_each_group(stages):
    before, after = stages[1]
    want = sorted((i, t) for (i, t), (_, _, c) in zip(rows(before), groups(rows(before), 5, 80)) if c == i)
    assert sorted(rows(after)) == want and len(want) < before.count()


def test_repeat_stage_takes_out_repeated_windows(stages):
    before, after = stages[2]
    texts = dict(rows(before))
    want = {i: (k.decode() if r else texts[i]) for i, _, r, k in repeated(rows(before), 50)}
    assert dict(rows(after)) == want
    assert all(r["n_chars"] == len(r["text"] or "") for r in after.collect())


def test_benchmark_stage_drops_documents_with_passages(stages, spark):
    before, after = stages[3]
    items = [normal(r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    exact = {i for i, t in rows(before) if any(x in normal(t) for x in items)}
    gone = {i for i, _ in rows(before)} - {i for i, _ in rows(after)}
    assert exact <= gone and len(gone) <= len(exact) + 2


def test_packing_stage_holds_every_token(stages):
    before, after = stages[4]
    encode = WordTokenizer(tokenizer_path())
    want = {i: len(x) // 4 + 1 for (i, _), x in zip(rows(before), encode([(t or "").encode() for _, t in rows(before)]))}
    got: dict = {}
    for r in after.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        assert r["doc_tokens"] == want[r["doc_id"]]
    assert got == want


def test_join_stage_edges(spark):
    docs = documents(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, None), (3, None), (4, ""), (None, "q r s")])
    out = corpus_pipeline.one_of_each_group(spark, docs, SF_SMALL)
    assert sorted(rows(out), key=str) == sorted([(1, "a b c d e f"), (3, None), (3, None), (4, ""), (None, "q r s")], key=str)
    assert corpus_pipeline.one_of_each_group(spark, documents(spark, []), SF_SMALL).count() == 0


def test_registered_names():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
