"""Benchmark decontamination: pigeonhole edit matching.

A test item of m characters with an error budget of k edits is split into k + 1 pieces; any
passage within k edits of it holds at least one piece unchanged. An Aho-Corasick automaton
finds all piece hits in one pass over a document, and Myers' bit-parallel distance verifies
the text around them. Items and texts are compared lower-cased with white space runs as one
blank.

Null or empty texts and items match nothing; an item too short for an edit is searched as it
is; repeated rows give repeated results; ties go to the first place in the text. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.common import small_batches, stored

MATCHES = "doc_id long, item_id long, distance int, start long, end long"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget`` + 1 consecutive pieces of about equal length, with their offsets."""
    n = len(item)
    cuts = [n * j // (budget + 1) for j in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(pattern: str, text: str) -> list[int]:
    """The smallest edit distance of ``pattern`` to a substring of ``text`` ending before each
    position 1, 2, ... (Myers 1999, on one long integer)."""
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    pv, mv, score, out = full, 0, m, []
    for c in text:
        eq = at.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1, mh << 1
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
        out.append(score)
    return out


def best_match(item: str, text: str, budget: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the nearest substring of ``text``, the first of several ends
    and then the latest start; None if all are beyond ``budget``."""
    ends = myers(item, text)
    if not ends or (least := min(ends)) > budget:
        return None
    end = ends.index(least) + 1
    back = myers(item[::-1], text[max(0, end - len(item) - budget) : end][::-1])
    # no substring that ends earlier is as near, so the nearest one found backwards ends here
    return least, end - (back.index(min(back)) + 1), end


def at_words(text: str, start: int, end: int) -> bool:
    """Whether no word goes on across either end of a place."""
    return not (start and text[start - 1].isalnum() and text[start].isalnum() or end < len(text) and text[end - 1].isalnum() and text[end].isalnum())


class Matcher:
    """The items of one block, ready to search texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        import ahocorasick

        self.items, self.tree = [], ahocorasick.Automaton()
        hits: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = normal(text)
            if text:
                budget = int(len(text) * rate)
                for offset, piece in pieces(text, budget):
                    hits.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item_id, text, budget))
        for piece, uses in hits.items():
            self.tree.add_word(piece, (len(piece), uses))
        if hits:
            self.tree.make_automaton()

    def search(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best match of every item found."""
        if not self.items or not text:
            return
        spans: dict[int, list[list[int]]] = {}
        whole: dict[int, int] = {}
        for last, (size, uses) in self.tree.iter(text):
            for k, offset in uses:
                _, item, budget = self.items[k]
                at = last + 1 - size - offset
                if not budget:  # the piece is the item; one as short stands as words of its own
                    if k not in whole and at_words(text, at, last + 1):
                        whole[k] = at
                    continue
                a, b = max(0, at - budget), min(len(text), at + len(item) + budget)
                held = spans.setdefault(k, [])
                if held and a <= held[-1][1] and b >= held[-1][0]:
                    held[-1] = [min(a, held[-1][0]), max(b, held[-1][1])]
                else:
                    held.append([a, b])
        for k, at in whole.items():
            yield self.items[k][0], 0, at, at + len(self.items[k][1])
        for k, windows in spans.items():
            item_id, item, budget = self.items[k]
            found = [(d, a + s, a + e) for a, b in windows if (m := best_match(item, text[a:b], budget)) for d, s, e in [m]]
            if found:
                yield item_id, *min(found)


def contaminated(docs: DataFrame, items: DataFrame, rate: float = 0.08, block_chars: int = 4_000_000) -> DataFrame:
    """One row (doc_id, item_id, distance, start, end) for each document and item of which it
    holds a passage within ``rate`` edits a character; places are in the normal form.

    The items are the stated query set. They are sent to the executors in blocks of about
    ``block_chars`` characters, whatever their number; every document is searched for each
    block."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item"))
    items = items.where(F.length("item") > 0)
    small_batches(docs.sparkSession)
    total = items.agg(F.coalesce(F.sum(F.length("item")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_chars))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).where(F.length("text") > 0)
    out = None
    for k in range(blocks):
        block = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).orderBy("item_id").collect()]
        found = texts.mapInArrow(_searcher(block, rate), MATCHES)
        if blocks > 1:  # its results are written and the block is let go before the next one is read
            found = stored(found)
        out = found if out is None else out.unionByName(found)
    return out


def _searcher(block: list[tuple[int, str]], rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, rate)
        for batch in batches:
            rows = [(doc_id, *hit) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for hit in matcher.search(normal(text))]
            cols = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["doc_id", "item_id", "distance", "start", "end"])

    return run
