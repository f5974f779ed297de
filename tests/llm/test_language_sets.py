"""Language sets of any size."""

from __future__ import annotations

import numpy as np

from surfacekit.llm.language_mixture import identify


def separated(languages, buckets=120, seed=3):
    rnd = np.random.default_rng(seed)
    p = np.full((languages, buckets), 0.02)
    for k in range(languages):
        p[k, k * 12 : k * 12 + 12] += rnd.random(12) + 1
    return p / p.sum(axis=1, keepdims=True)


def test_even_mixtures_of_any_number_of_languages():
    p = separated(8)
    rnd = np.random.default_rng(5)
    for n in (1, 2, 4, 5, 6, 8):
        counts = np.stack([rnd.multinomial(6000, p[:n].mean(axis=0)) for _ in range(5)]).astype(float)
        shares = identify(counts, p, 2.0)
        assert ((shares > 0.05).sum(axis=1) == n).all()
        assert np.abs(shares[:, :n] - 1 / n).max() < 0.05 and shares[:, n:].max(initial=0) < 0.01


def test_short_texts_take_no_more_languages_than_they_pay_for():
    p = separated(8)
    counts = np.zeros((1, p.shape[1]))
    counts[0, :2] = 1
    assert (identify(counts, p, 2.0) > 0).sum() == 1
