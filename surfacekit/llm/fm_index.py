"""FM-index over integer symbols: a wavelet tree of the Burrows-Wheeler transform, stored as
one packed bit plane per level with a running count for every 64 bits.

All searches are batched: a step extends many patterns by one symbol each, in numpy.
"""

from __future__ import annotations

import numpy as np

_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class WaveletTree:
    """Rank of a symbol before a position, for many (symbol, position) at once. Level by level
    the symbols are parted by one bit, zeros before ones, from the highest bit down."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.planes, self.counts, self.zeros = bits, [], [], []
        n, top = len(symbols), 1 << bits
        for level in range(bits - 1, -1, -1):
            ones = ((symbols >> level) & 1).astype(bool)
            plane = np.packbits(np.concatenate((ones, np.zeros(-n % 64 + 64, bool))), bitorder="little").view(np.uint64)
            counts = np.zeros(len(plane) + 1, dtype=np.int64)
            np.cumsum(np.bitwise_count(plane), out=counts[1:])
            self.planes.append(plane)
            self.counts.append(counts)
            self.zeros.append(n - int(counts[-1]))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        begin = np.zeros(top, dtype=np.int64)  # where each symbol's own run begins, at the last level
        self.begin = self._down(np.arange(top), begin)

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for plane, counts, zeros, level in zip(self.planes, self.counts, self.zeros, range(self.bits - 1, -1, -1)):
            word = at >> 6
            ones = counts[word] + np.bitwise_count(plane[word] & _BELOW[at & 63])
            at = np.where((symbol >> level) & 1 != 0, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(symbol, at) - self.begin[symbol]


def suffix_order(symbols: np.ndarray, depth: int, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the suffixes, sorted by their first ``depth`` symbols at least (by doubling), and
    for each place the range of the suffixes with the same first ``start`` symbols (a power of
    two): its begin in that order and its size."""
    rank, done, n = symbols.astype(np.int64), 1, len(symbols)
    begin = size = np.empty(0, dtype=np.int64)
    while done < max(depth, start):
        after = np.zeros(n, dtype=np.int64)
        after[: max(0, n - done)] = rank[done:] + 1
        key = rank * (int(rank.max(initial=0)) + 2) + after
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate((np.zeros(min(1, n), bool), ranked[1:] != ranked[:-1])))
        done *= 2
        if done == start:
            sizes = np.bincount(rank)
            begin, size = (np.cumsum(sizes) - sizes)[rank], sizes[rank]
    return np.argsort(rank), begin, size


class FMIndex:
    """Counts of patterns of up to ``depth`` symbols in ``symbols`` (0 is a separator). ``begin``
    and ``size`` hold the interval of the ``start`` symbols from each place on, so that searches
    need not begin at the first symbol."""

    def __init__(self, symbols: np.ndarray, depth: int, start: int = 16) -> None:
        order, self.begin, self.size = suffix_order(symbols, depth, start)
        top = int(symbols.max(initial=0))
        self.start = start
        self.tree = WaveletTree(symbols[order - 1], max(1, top.bit_length()))
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=top + 1))))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of each pattern with ``symbol`` put before it (backward search)."""
        both = self.tree.rank(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
        return self.before[symbol] + both[: len(symbol)], self.before[symbol] + both[len(symbol) :]


def repeated_spans(index: FMIndex, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                   least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matching statistics of the patterns ``symbols[starts:ends]``, parts of the indexed symbols:
    (pattern, first, last) of spans of ``least`` symbols or more (and of more than the index's
    start) that occur twice or more. The spans hold every such window of a pattern.

    Each round extends all open patterns to the left from their present end as far as two
    occurrences are left. What remains are windows that hold the symbol where that stopped."""
    which = np.flatnonzero(ends - starts >= least)
    at = ends[which] - 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(which):
        first = at - (index.start - 1)
        lo = index.begin[first]
        hi = lo + index.size[first]
        twice = hi - lo >= 2
        open_ = np.flatnonzero(twice & (first > starts[which]))
        lo, hi = lo[open_], hi[open_]
        while len(open_):
            lo, hi = index.extend(symbols[first[open_] - 1], lo, hi)
            go = hi - lo >= 2
            open_, lo, hi = open_[go], lo[go], hi[go]
            first[open_] -= 1
            go = first[open_] > starts[which[open_]]
            open_, lo, hi = open_[go], lo[go], hi[go]
        hit = twice & (at - first + 1 >= least)
        found.append((which[hit], first[hit], at[hit]))
        at = np.where(hit, first + least - 2, at - 1)
        more = (at - starts[which] + 1 >= least) & ~(hit & (first == starts[which]))
        which, at = which[more], at[more]
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    return tuple(np.concatenate(c) for c in zip(*found))
