from __future__ import annotations

import numpy as np

from surfacekit.llm import hamming_search


def table_of(spark, x):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")


def found(df):
    got = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_ten_vectors_have_all_nine_others(spark):
    x = np.random.default_rng(3).normal(size=(10, 64))
    df = table_of(spark, x)
    got = found(hamming_search.nearest(df, df))
    for q in range(10):
        assert got[q] == sorted((j for j in range(10) if j != q), key=lambda j: (-float(x[j] @ x[q]), j))


def test_outliers_beside_tight_clusters_are_filled(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(30, 32))
    x = np.concatenate([np.repeat(middles, 40, axis=0) + 0.001 * rng.normal(size=(1200, 32)), 3 * rng.normal(size=(12, 32))])
    df = table_of(spark, x)
    for size in (16_384, 300):
        got = found(hamming_search.nearest(df, df.where("vec_id % 200 = 0 or vec_id >= 1200"), shard_size=size))
        assert set(got) == {*range(0, 1200, 200), *range(1200, 1212)} and {len(v) for v in got.values()} == {20}
    assert all(set(got[q]) <= set(range(q, q + 40)) for q in range(0, 1200, 200))


def test_widened_codes_end_with_all_bits():
    codes = hamming_search.Codes(np.zeros(1), np.zeros((1, 64)), hamming_search.share_radius(9, 8))
    assert [c.radius for c in codes.widened()] == [37, 64]
    assert hamming_search.Codes(np.zeros(1), np.zeros((1, 8)), (8,)).widened() == []
