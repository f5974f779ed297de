"""Words and word n-grams of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than blank, tab, LF, VT, FF and CR -- the pattern
``[^\\x20\\x09-\\x0D]+`` on UTF-8 text. A word's hash is a polynomial over per-byte random
values modulo 2**64, finished with a bit mixer; equal words always have equal hashes.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(lower: bool) -> np.ndarray:
    out = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if lower:
        out[65:91] = out[97:123]
    return out


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Splits and hashes texts; keeps its power tables between calls."""

    def __init__(self, lower: bool = False) -> None:
        self.values, self.pw, self.ipw = _byte_values(lower), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """texts: bytes or None. Returns (bytes joined by LF, word starts, word ends, word
        hashes, first word of each text and, last, the number of words)."""
        joined = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", dtype=np.uint8)
        solid = np.empty(len(joined) + 1, dtype=np.int8)
        solid[0], solid[1:] = 0, ~SPACE[joined]
        edge = np.diff(solid)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        hashes = self.spans(joined, starts, ends)
        lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), dtype=np.int64, count=len(texts))
        firsts = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
        return joined, starts, ends, hashes, firsts

    def spans(self, joined: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from each start to each end."""
        n = len(joined)
        if len(self.pw) < n + 1:
            self.pw = _powers(_BASE, n + 1)
            self.ipw = _powers(pow(_BASE, -1, 2**64), n + 1)
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(self.values[joined] * self.pw[:n], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.ipw[starts])


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (shorter by n - 1 than ``words``)."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    size = len(words) - n + 1
    total = np.full(size, n, dtype=np.uint64)
    for j, c in enumerate(_powers(0xA0761D6478BD642F, n + 1)[1:]):
        total += words[j : j + size] * c
    return mix(total)


def sequence_hash(words: np.ndarray, salt: int) -> int:
    """Hash of a whole word sequence, distinct from all n-gram hashes by its salt."""
    total = np.array([salt], dtype=np.uint64)
    for k in range(len(words)):
        total = mix(total * np.uint64(_BASE) + words[k : k + 1])
    return int(total[0])


def range_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the word sequence from each start to each end (exclusive)."""
    pw, ipw = _powers(_BASE, len(words) + 1), _powers(pow(_BASE, -1, 2**64), len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * pw[: len(words)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * ipw[starts] + (ends - starts).astype(np.uint64))
