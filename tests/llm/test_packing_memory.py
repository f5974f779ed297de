"""What a worker encodes at once stays small."""

from __future__ import annotations

from surfacekit.llm import packing


def test_texts_are_encoded_in_small_chunks():
    texts = [b"word " * 700, None, b""] * 900
    sizes = []

    def encode(part):
        sizes.append(sum(len(t or b"") for t in part))
        return [t or b"" for t in part]

    assert list(packing._encoded(encode, texts)) == [t or b"" for t in texts]
    assert max(sizes) <= 1 << 18 and sum(sizes) == 900 * 3500
