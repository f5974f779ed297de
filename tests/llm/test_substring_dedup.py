from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from helpers import documents, prose, repeated

from surfacekit.llm import substring_dedup
from surfacekit.llm.fm_index import FMIndex, WaveletTree, repeated_spans


def corpus(vocabulary=60):
    passage = prose(1, 55, vocabulary)
    rows = [(k, f"{prose(10 + k, 40, vocabulary)} {passage}\n{prose(50 + k, 30, vocabulary)}") for k in range(12)]
    rows += [(20, "\n".join(["the same line again and again"] * 20)), (21, prose(3, 34, vocabulary)), (22, prose(3, 34, vocabulary)),
             (23, prose(4, 35, vocabulary)), (24, prose(4, 35, vocabulary)), (25, None), (26, ""), (27, " \t"), (28, "a"),
             (29, "x " * 200), (23, prose(4, 36, vocabulary)), (30, passage.replace(" ", "\x0b"))]
    return rows


def check(spark, rows, window, **options):
    df = substring_dedup.remove_repeats(documents(spark, rows, "row spans n_words"), window=window, **options)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())
    assert got == sorted((i, n, r, hashlib.sha256(k).hexdigest()) for i, n, r, k in repeated(rows, window))
    return df


def test_removed_words_equal_brute_force(spark):
    df = check(spark, corpus(), 35)
    assert "n_removed" in df.columns and df.where("n_removed > 0").count() > 10


@pytest.mark.parametrize("options", [{"gram": 3, "hot": 1}, {"gram": 1, "hot": 1000}, {"gram": 3, "shard_words": 30},
                                     {"gram": 3, "bundle": 1}, {"gram": 3, "bundle": 40, "hot": 3}])
def test_short_windows_hot_anchors_and_small_shards(spark, options):
    check(spark, [(k, prose(k, 60, 5)) for k in range(8)] + corpus(8), 6, **options)


def test_a_passage_of_many_texts_is_one_row_a_segment_and_task(spark):
    passage = prose(1, 80)
    rows = [(k, f"{prose(100 + k, 20)} {passage} {prose(900 + k, 20)}") for k in range(300)]
    docs = documents(spark, rows * 2).coalesce(1).selectExpr("xxhash64(text) row", "text")
    table = substring_dedup.segment_table(docs, 35, 12, 1 << 17).collect()
    shared = [r for r in table if r["copies"] == 600]
    assert shared and all(len({(m["row"], m["off"]) for m in (r, *r["others"])}) == 300 for r in shared)
    assert len({(r["anchor"], r["seg"]) for r in table}) == len(table)
    check(spark, rows, 35)


def test_members_are_dealt_out_within_their_bundle(spark):
    passage = prose(1, 400)
    own = [" ".join(f"w{k}x{i}" for i in range(20)) for k in range(200)]
    rows = [(k, f"{w} {passage} {w[::-1]}") for k, w in enumerate(own)]
    docs = documents(spark, rows).repartition(4).selectExpr("xxhash64(text) row", "text")
    found = substring_dedup.repeated_intervals(docs, 35, 12, 2000, 500_000, 700)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert all([(s["lo"], s["hi"]) for s in r["spans"]] == [(20, 420)] for r in found.collect()) and found.count() == 200
    table = substring_dedup.segment_table(docs, 35, 12, 700).collect()
    bundles = {}
    for r in table:
        for m in (r, *(r["others"] or [])):
            bundles.setdefault(m["row"], set()).add(r["bundle"])
    assert len(bundles) == 200 and all(len(b) == 1 for b in bundles.values()) and len(set().union(*bundles.values())) >= 4


def test_united_intervals_equal_a_plain_loop():
    rnd = np.random.default_rng(2)
    for n in (1, 2, 60):
        row, lo = rnd.integers(-3, 4, n), rnd.integers(0, 90, n)
        hi = lo + rnd.integers(1, 9, n)
        got = list(zip(*(c.tolist() for c in substring_dedup.united(row, lo, hi))))
        want = {(r, x) for r, a, b in zip(row.tolist(), lo, hi) for x in range(a, b)}
        assert {(r, x) for r, a, b in got for x in range(a, b)} == want and got == sorted(got)
        assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(got, got[1:]))


def test_text_that_loses_nothing_stays_and_empty_table(spark):
    rows = [(1, "a  b\nc"), (2, None)]
    out = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(documents(spark, rows), window=35).collect()}
    assert out == {1: "a  b\nc", 2: None}
    assert substring_dedup.remove_repeats(documents(spark, []), window=35).count() == 0


def test_wavelet_rank_and_backward_search_equal_counting():
    rnd = np.random.default_rng(5)
    x = rnd.integers(0, 11, 500)
    tree = WaveletTree(x, 4)
    for _ in range(200):
        c, i = int(rnd.integers(0, 11)), int(rnd.integers(0, 501))
        assert tree.rank(np.array([c]), np.array([i]))[0] == (x[:i] == c).sum()
    line = np.concatenate((rnd.integers(1, 4, 300), [0]))
    index = FMIndex(line, 32, 4)
    for at in range(0, 280, 7):
        lo, hi = index.begin[at : at + 1], index.begin[at : at + 1] + index.size[at : at + 1]
        pattern = line[at : at + 4].tolist()
        for k in range(at - 1, max(-1, at - 6), -1):
            lo, hi = index.extend(line[k : k + 1], lo, hi)
            pattern = [int(line[k]), *pattern]
            assert hi[0] - lo[0] == sum(line[j : j + len(pattern)].tolist() == pattern for j in range(len(line)))


def test_spans_hold_exactly_the_repeated_windows():
    rnd = random.Random(8)
    for _ in range(30):
        least = 6
        parts = [[rnd.randrange(1, 4) for _ in range(rnd.randrange(6, 14))] for _ in range(20)]
        line, starts, ends = [], [], []
        for p in parts:
            starts.append(len(line))
            line += [*p, 0]
            ends.append(len(line) - 1)
        line = np.array(line)
        part, first, last = repeated_spans(FMIndex(line, 16, 2), line, np.array(starts), np.array(ends), least)
        windows = [tuple(line[s + k : s + k + least]) for s, e in zip(starts, ends) for k in range(e - s - least + 1)]
        want = {s + k + j for s, e in zip(starts, ends) for k in range(e - s - least + 1)
                if windows.count(tuple(line[s + k : s + k + least])) > 1 for j in range(least)}
        assert want == {x for a, b in zip(first, last) for x in range(a, b + 1)}
