from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import documents

from conftest import SF_MID
from surfacekit.llm import language_mixture, licences, quality
from surfacekit.llm.common import table

# --- quality -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    return quality.score_quality(docs, labels).join(labels, "doc_id", "left").cache()


def test_quality_on_the_held_out_fold(scored, spark):
    assert scored.count() == table(spark, SF_MID, "documents").count()
    rows = scored.where("held_out and quality is not null").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.95
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good)
    assert scored.where("score < 0 or score > 1 or score is null or predicted != int(score >= 0.3)").count() == 0


def test_quality_does_not_look_at_labels_of_the_held_out_fold(spark):
    docs = table(spark, SF_MID, "documents")
    labels = table(spark, SF_MID, "labels")
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality")
    a = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, flipped).collect()}
    assert a == b


def test_statistics_edges_and_empty_tables(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a b\na b\n#x 12"), (4, "a b\na b\n#x 12"), (None, "text")]
    stats = quality.text_statistics(documents(spark, rows, "symbol_share _w longest_word")).collect()
    by = {r["doc_id"]: r.asDict() for r in stats}
    assert by[1]["log_chars"] == by[2]["log_words"] == 0 and by[1]["chars_per_word"] == 0
    assert by[4]["repeated_lines"] == pytest.approx(1 / 3) and by[4]["symbol_words"] == pytest.approx(1 / 6)
    assert by[4]["distinct_words"] == pytest.approx(4 / 6) and by[4]["longest_word"] == 2
    labels = spark.createDataFrame([(1, 1), (4, None)], "doc_id long, quality int")
    out = quality.score_quality(documents(spark, rows), labels).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    assert quality.score_quality(documents(spark, []), labels.limit(0)).count() == 0


def test_rules_compile_to_their_meaning(spark):
    dump = "Tree\n  If (feature 0 <= 0.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 0.5)\n   Predict: 1.0\n"
    paths = quality.tree_paths(dump, ["a", "b"])
    assert paths == {(("a", "<=", 0.5),), (("a", ">", 0.5),), (("a", "<=", 0.5), ("b", "<=", 2.0)), (("a", "<=", 0.5), ("b", ">", 2.0))}
    model = quality.RuleModel(0.25, (((("a", "<=", 0.5), ("b", ">", 2.0)), 1.5), ((("a", ">", 0.5),), -2.0)))
    df = spark.createDataFrame([(0.1, 3.0), (0.9, 3.0), (0.5, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(model.score()).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-z)) for z in (1.75, -1.75, 0.25)])


# --- language ------------------------------------------------------------------------------


def test_language_on_the_held_out_fold_and_mixtures(spark):
    docs = table(spark, SF_MID, "documents")
    out = language_mixture.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    rows = out.where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97
    model = language_mixture.learn(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 != 0"))
    pick = {x: max((r["text"] for r in docs.where(f"lang = '{x}'").collect()), key=len)[:3000] for x in ("de", "fr")}
    mixed = documents(spark, [(1, pick["de"] + "\n" + pick["fr"]), (2, pick["de"]), (3, None), (4, ""), (5, "12 .. !"), (6, "x" * 100000), (2, "a")], "held lang_pred")
    got = {}
    for r in language_mixture.detect(mixed, model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert {x["lang"] for x in got[1][0]["languages"]} >= {"de", "fr"} and 0.3 < got[1][0]["score"] < 0.8
    assert [got[k][0]["lang_pred"] for k in (3, 4, 5)] == ["und"] * 3 and got[3][0]["score"] == 0.0
    assert len(got[2]) == 2 and got[6][0]["lang_pred"] in model.names


def test_nothing_learned_and_empty_table(spark):
    docs = documents(spark, [(1, "some words", None), (2, None, "en")])
    assert {r["lang_pred"] for r in language_mixture.identify_languages(docs).collect()} == {"und"}
    assert language_mixture.identify_languages(documents(spark, [])).count() == 0


def test_mixture_equals_plain_expectation_maximisation():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(50), 3)
    counts = np.stack([rng.multinomial(4000, w @ p) for w in ([0.6, 0.4, 0], [1, 0, 0], [0.2, 0.3, 0.5])]).astype(float)
    out = language_mixture.identify(counts, p, 2.0)
    for row, c in zip(out, counts):
        pi = (row > 0) / (row > 0).sum()
        for _ in range(500):
            share = pi[:, None] * p
            pi = (share / share.sum(axis=0) * c).sum(axis=1) / c.sum()
        assert np.allclose(pi, row, atol=0.02)
    assert (out[1] == [1, 0, 0]).all() and (out[0] > 0).tolist() == [True, True, False]


# --- licences ------------------------------------------------------------------------------

TEXT = """The license of the song is free.
Released under the MIT license
\t
© All Rights Reserved, 2020
Licensed under the Apache License, Version 2.0.
licensed under cc by-sa 4.0
This work is licensed under the GNU General Public License, version 3.
He drove on the public road with a general license version."""


@pytest.fixture(scope="module")
def licence_model(spark):
    return licences.fit(table(spark, SF_MID, "documents"))


def test_licence_families_of_written_notices(spark, licence_model):
    docs = documents(spark, [(1, TEXT), (1, TEXT), (2, None), (3, ""), (4, "word " * 20000)], "row paragraph grams line")
    got = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in licences.predict(licences.paragraphs(docs), licence_model).collect())
    one = [(1, 1, "mit"), (1, 3, "proprietary"), (1, 4, "apache-2.0"), (1, 5, "cc-by-sa"), (1, 6, "gpl-3.0")]
    assert got == sorted(one * 2)


def test_licence_scores_equal_brute_force(spark, licence_model):
    docs = documents(spark, [(1, TEXT)])
    got = {r["paragraph"]: r["probability"] for r in licences.predict(licences.paragraphs(docs), licence_model).collect()}
    weights = {g: (w, pair) for g, w, pair in licence_model.rows}
    for r in licences.paragraphs(docs).collect():
        hits = [weights[g] for g in r["grams"] if g in weights]
        if not hits:
            continue
        other = 1 - sum(p for _, p in hits) / r["pairs"] if r["pairs"] else 1.0
        z = [sum(w[k] for w, _ in hits) + licence_model.intercepts[k] + other * licence_model.others[k] for k in range(len(licence_model.names))]
        prob = [math.exp(x - max(z)) for x in z]
        best = prob.index(max(prob))
        family = licence_model.names[best] != licences.UNKNOWN and max(prob) / sum(prob) >= licence_model.threshold
        assert (r["paragraph"] in got) == family
        if family:
            assert got[r["paragraph"]] == pytest.approx(max(prob) / sum(prob))


def test_licence_scan_finds_the_planted_lines_natively(spark):
    docs = table(spark, SF_MID, "documents")
    out = licences.scan(docs)
    assert out.columns == ["doc_id", "paragraph", "family", "probability", "similarity", "confirmed"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    lines = docs.selectExpr("doc_id", "posexplode(split(text, '\n')) as (paragraph, line)")
    planted = {(r["doc_id"], r["paragraph"]) for r in lines.where(r"line rlike '(Licensed under|licensed under the GNU|MIT License|All rights reserved)'").collect()}
    got = {(r["doc_id"], r["paragraph"]) for r in out.where("confirmed").collect()}
    assert got == planted and len(got) > 10


def test_licence_scan_of_an_empty_table(spark):
    assert licences.scan(documents(spark, [])).count() == 0
