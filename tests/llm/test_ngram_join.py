from __future__ import annotations

import random

import numpy as np
from helpers import documents, edited, groups, prose

from surfacekit.llm import ngram_join
from surfacekit.llm.components import components
from surfacekit.llm.words import WordHasher, grams


def corpus():
    rows = []
    line = prose(1, 20)
    for k in range(30):
        base = prose(100 + k, 30 + 5 * k)
        rows.append(base if k % 2 else f"{base}\n{line}")
        rows += [edited(base, 7 * k + j, 1 + j) for j in range(k % 5)]
        rows += [base.upper().replace(" ", "\t")] * (k % 3)
    rows += [edited(prose(5, 200), k, 2) for k in range(25)]  # a large group of near copies
    rows += ["one two three", "ONE two  three", "one two", "", None, " \n\t", "é É é É", "é É é É"]
    ids = list(range(1000, 1000 + len(rows)))
    random.Random(4).shuffle(ids)
    return list(zip(ids, rows))


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, df.collect()), key=str)


def test_groups_equal_brute_force(spark):
    rows = corpus()
    for n, percent in ((4, 85), (5, 80)):
        got = found(ngram_join.near_duplicates(documents(spark, rows, "component_id node size row"), n=n, percent=percent))
        assert got == sorted(groups(rows, n, percent), key=str)
        assert any(c != i for i, _, c in got)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "only here x y z"), (2, None), (2, None), (1, "q")]
    assert found(ngram_join.near_duplicates(documents(spark, rows), 4, 85)) == sorted(groups(rows, 4, 85), key=str)
    assert found(ngram_join.near_duplicates(documents(spark, []), 4, 85)) == []


def test_broadcast_and_shuffle_forms_agree(spark, monkeypatch):
    rows = corpus()[:40]
    monkeypatch.setattr(ngram_join, "small_side", lambda df: df)
    assert found(ngram_join.near_duplicates(documents(spark, rows), 4, 85)) == sorted(groups(rows, 4, 85), key=str)


def test_prefix_holds_a_shared_gram_of_every_link():
    rule = ngram_join.Rule(4, 85)
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randrange(1, 60)
        x = set(rnd.sample(range(100), n))
        y = set(x)
        for _ in range(rnd.randrange(0, 6)):
            y.discard(rnd.randrange(100))
            y.add(rnd.randrange(100))
        if y and 100 * len(x & y) >= 85 * len(x | y):
            assert set(sorted(x)[: rule.prefix(len(x))]) & set(sorted(y)[: rule.prefix(len(y))])


def test_components_of_a_long_chain_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_follow_words_not_places():
    texts = ["A b\tc  A", None, "", "x\x0bA b c", "é\x85 A"]
    raw = [t.encode() if t else t for t in texts]
    _, starts, ends, hashes, firsts = WordHasher()(raw)
    words = [w for t in raw for w in (t or b"").split()]
    assert len(words) == len(hashes) and list(np.diff(firsts)) == [len((t or b"").split()) for t in raw]
    assert len(set(hashes.tolist())) == len(set(words))
    assert WordHasher(lower=True)([b"ABC"])[3][0] == WordHasher(lower=True)([b"zz abc"])[3][1]
    one = WordHasher()([b"p q r s", b"q r s t"])[3]
    assert grams(one, 3)[1] == grams(one, 3)[4]
