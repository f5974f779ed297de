"""The licence model is learned from the lines of all documents."""

from __future__ import annotations

import pytest
from helpers import documents
from pyspark.sql import functions as F

from surfacekit.llm import licences


def test_lines_of_any_document_count(spark):
    rows = [(k, f"the bird number {k} sings a song of its own") for k in range(1300)]
    docs = documents(spark, rows)
    # the documents with the largest hashes: a sample of 1,000 by hash would not have them
    late = {r[0] for r in docs.orderBy(F.xxhash64("doc_id").desc()).limit(300).select("doc_id").collect()}
    other = documents(spark, [(k, f"the public work number {k} of the foundation is licensed" if k in late else t) for k, t in rows])
    one, two = licences.fit(docs), licences.fit(other)
    weights = [{g: w for g, w, _ in m.rows} for m in (one, two)]
    none = (0.0,) * len(one.names)
    moved = max(abs(a - b) for g in weights[0] | weights[1] for a, b in zip(weights[0].get(g, none), weights[1].get(g, none)))
    assert moved > 0.01


def test_a_half_that_looks_like_notices_raises_the_threshold(spark):
    words = "red blue green grey black white brown pink gold jade".split()
    notice = "the Apache License"
    texts = [f"{notice} {a} {b} {c}" for a in words for b in words for c in words if len({a, b, c}) == 3]
    docs = documents(spark, list(enumerate(texts)))
    paras = licences.stored(licences.held_grams(licences.paragraphs(docs)))
    model, found = licences.learn(paras, outweigh=0.0)
    # lines without any weight in training are taken for notices; the other half keeps them out
    tested = paras.where("ordinary and half = 1").count()
    wrong = found.where("ordinary and half = 1").count()
    assert tested > 100 and wrong <= tested * 0.001
    assert model.threshold == pytest.approx(round(model.threshold * licences.STEPS) / licences.STEPS)
