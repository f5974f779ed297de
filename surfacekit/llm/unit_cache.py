"""Encoding by units: texts are split where a tokenizer never merges, and each distinct unit is
encoded once per Python worker and kept within a bound."""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np

from surfacekit.llm.words import WordHasher

assert array("I").itemsize == 4 and sys.byteorder == "little"
LONG_TEXT = 1 << 20  # code points; beyond it units are taken in blocks
BLOCK = 100_000


class UnitEncoder:
    """``pattern`` gives, for a text, the compiled pattern (without groups) that finds its units;
    ``encode`` gives the ids of a list of units. Units are kept in two generations of up to ``most`` code
    points each: when the newer is full it becomes the older one, and what is met again moves up, so
    frequent units stay and memory has a bound on any corpus."""

    def __init__(self, pattern: Callable[[str], re.Pattern], encode: Callable[[list[str]], Iterable[list[int]]], most: int = 1 << 20) -> None:
        self.pattern, self.encode, self.most = pattern, encode, most
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _blocks(self, text: str) -> Iterator[list[str]]:
        found = (m.group() for m in self.pattern(text).finditer(text))
        while block := list(islice(found, BLOCK)):
            yield block

    def _learn(self, units: set[str]) -> None:
        if self.size > self.most:
            self.kept, self.older, self.size = {}, self.kept, 0
        new = [u for u in units if u not in self.kept]
        self.size += sum(map(len, new))
        if self.older:
            met = {u: self.older[u] for u in new if u in self.older}
            self.kept.update(met)
            new = [u for u in new if u not in met]
        for unit, ids in zip(new, self.encode(new)):
            self.kept[unit] = array("I", ids).tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; null: none."""
        out = [b""] * len(texts)
        short = {k: self.pattern(t).findall(t) for k, t in enumerate(texts) if t and len(t) <= LONG_TEXT}
        self._learn(set().union(*short.values()))
        for k, units in short.items():
            out[k] = b"".join(map(self.kept.__getitem__, units))
        for k, t in enumerate(texts):
            if t and k not in short:
                parts = []
                for units in self._blocks(t):
                    self._learn(set(units))
                    parts.append(b"".join(map(self.kept.__getitem__, units)))
                out[k] = b"".join(parts)
        return out


class SharedUnits:
    """The ids of many texts by several encoders that share their units: a unit is a run of blanks,
    tabs and line ends and what follows it up to the next such run. Units are told apart by 64-bit hashes, and
    each is encoded once; beyond ``most`` units all are forgotten. Texts go in slices of about ``part`` bytes."""

    SPACE = np.isin(np.arange(256), [9, 10, 32])
    BOUND = re.compile(rb"(?<=[^ \t\n])[ \t\n]")

    def __init__(self, encoders: list[Callable[[list[str]], list[list[int]]]], most: int = 250_000, part: int = 1 << 19) -> None:
        self.encoders, self.most, self.part = encoders, most, part
        self.hasher = WordHasher()
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.ids = [np.zeros(0, dtype=np.int32) for _ in self.encoders]
        self.begin = [np.zeros(1, dtype=np.int64) for _ in self.encoders]

    def _slices(self, texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
        """(text's place, bytes) in groups; a text beyond ``part`` bytes is cut in front of units."""
        group, size = [], 0
        for k, text in enumerate(texts):
            start = 0
            while start < len(text):
                bound = self.BOUND.search(text, start + self.part) if len(text) - start > self.part else None
                end = bound.start() if bound else len(text)
                if group and size + end - start > self.part:
                    yield group
                    group, size = [], 0
                group.append((k, text[start:end]))
                size += end - start
                start = end
        if group:
            yield group

    def __call__(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each encoder, the ids of all texts in a row and the number of each text's."""
        flat = [[np.zeros(0, dtype=np.int32)] for _ in self.encoders]
        counts = [np.zeros(len(texts), dtype=np.int64) for _ in self.encoders]
        for group in self._slices(texts):
            place = np.array([k for k, _ in group])
            for e, (ids, sizes) in enumerate(self._encoded([x for _, x in group])):
                flat[e].append(ids)
                np.add.at(counts[e], place, sizes)
        return [(np.concatenate(f), c) for f, c in zip(flat, counts)]

    def _encoded(self, parts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        if len(self.number) > self.most:
            self._forget()
        raw = b"".join(parts)
        joined, bounds = np.frombuffer(raw, dtype=np.uint8), np.cumsum([0, *map(len, parts)])
        space = self.SPACE[joined]
        first = np.concatenate(([True], space[1:] & ~space[:-1]))
        first[bounds[:-1]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(joined))
        hashes, at, which = np.unique(self.hasher.spans(joined, starts, ends), return_index=True, return_inverse=True)
        keys = hashes.tolist()
        new = [k for k, h in enumerate(keys) if h not in self.number]
        if new:
            self._learn([keys[k] for k in new], [raw[a:b].decode() for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
        unit = np.fromiter(map(self.number.__getitem__, keys), dtype=np.int64, count=len(keys))[which]
        heads = np.searchsorted(starts, bounds)
        out = []
        for ids, begin in zip(self.ids, self.begin):
            sizes = np.diff(begin)[unit]
            stops = np.cumsum(sizes)
            places = np.repeat(begin[unit] - stops + sizes, sizes) + np.arange(int(stops[-1]))
            out.append((ids[places], np.diff(np.concatenate(([0], stops))[heads])))
        return out

    def _learn(self, hashes: list[int], units: list[str]) -> None:
        base = len(self.number)
        self.number.update((h, base + k) for k, h in enumerate(hashes))
        for e, encode in enumerate(self.encoders):
            found = encode(units)
            self.ids[e] = np.concatenate((self.ids[e], np.fromiter(chain.from_iterable(found), dtype=np.int32)))
            self.begin[e] = np.concatenate((self.begin[e], self.begin[e][-1] + np.cumsum([len(x) for x in found])))
