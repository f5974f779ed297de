"""Packing: first-fit decreasing with a tournament tree of bin capacities.

Documents are tokenised, dealt into randomised groups of about ``group_docs`` documents, and
each group is packed on its own: whole sequences are cut from documents longer than one, the
rests go in order of decreasing length into the first bin that has room. A tournament tree
over the bins' free room finds that bin in logarithmic time. What then stands in the least
filled bins is cut to fill gaps of at least ``min_cut`` tokens elsewhere, and the last bins are
cut at powers of two, which need no padding.

Null and empty texts hold the end id alone; repeated rows are packed each; ties go by doc_id
and then by the text's ids; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.common import small_batches, text_chunks, worker_cache
from surfacekit.llm.words import SPACE, WordHasher

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


_CLASS = np.full(256, 2, dtype=np.uint8)  # 0 white space, 1 letters, 2 other signs
_CLASS[SPACE] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_ODD = np.zeros(256, dtype=bool)  # bytes of chunks that are encoded whole: see WordTokenizer
_ODD[[ord("'"), ord("<"), *range(1, 9), *range(14, 32), 0xC2, *range(0xCA, 256)]] = True


class WordTokenizer:
    """Encodes many texts at once by their units, each encoded once and kept.

    The tokenizer drops white space, lower-cases, and never joins across white space or from
    letters to signs, so a text's ids are those of its runs of letters and of signs in order.
    That holds for ASCII and the letters U+00C0 to U+024F; a chunk between white space with any
    other sign, an apostrophe or a "<" (contractions, special tokens, marks that combine) is a
    unit as a whole. New words of a batch are encoded in one call and told apart by their last
    token, which carries the end mark of a word. Units are kept by a 64-bit hash."""

    def __init__(self, path: str, most: int = 200_000) -> None:
        from tokenizers import Tokenizer

        self.encoder, self.most = Tokenizer.from_file(path), most
        vocabulary = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.lower, self.exact = WordHasher(lower=True), WordHasher()
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.ids, self.begin = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.number) > self.most:
            self._forget()
        joined = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", dtype=np.uint8)
        starts, ends, whole = _units(joined)
        hashes = self.lower.spans(joined, starts, ends)
        if whole.any():
            hashes[whole] = ~self.exact.spans(joined, starts[whole], ends[whole])
        order = np.argsort(hashes)
        ranked = hashes[order]
        new = np.concatenate((np.ones(min(1, len(order)), dtype=bool), ranked[1:] != ranked[:-1]))
        first, which = order[new], np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        keys = ranked[new].tolist()
        new = [k for k, h in enumerate(keys) if h not in self.number]
        if new:
            raw, at = joined.tobytes(), first[new]
            self._learn([keys[k] for k in new], [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())],
                        (_CLASS[joined[starts[at]]] == 1) & ~whole[at])
        unit = np.fromiter(map(self.number.__getitem__, keys), dtype=np.int64, count=len(keys))[which]
        sizes = np.diff(self.begin)[unit]
        stops = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.begin[unit] - stops + sizes, sizes) + np.arange(int(stops[-1]) if len(stops) else 0)].tobytes()
        bounds = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
        at = (4 * np.concatenate(([0], stops))[np.searchsorted(starts, bounds)]).tolist()
        return [ids[a:b] for a, b in zip(at, at[1:])]

    def _learn(self, hashes: list[int], units: list[bytes], words: np.ndarray) -> None:
        simple, rest = np.flatnonzero(words).tolist(), np.flatnonzero(~words).tolist()
        ids = np.asarray(self.encoder.encode(b" ".join([units[k] for k in simple]).decode(), add_special_tokens=False).ids, dtype="<u4")
        sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(sizes) != len(simple):  # a word that is not one word to the tokenizer
            simple, rest, ids, sizes = [], simple + rest, ids[:0], sizes[:0]
        parts = [np.asarray(e.ids, dtype="<u4") for e in
                 self.encoder.encode_batch_fast([units[k].decode() for k in rest], add_special_tokens=False)]
        base = len(self.number)
        self.number.update((hashes[k], base + n) for n, k in enumerate(simple + rest))
        self.ids = np.concatenate((self.ids, ids, *parts))
        sizes = np.concatenate((sizes, np.array([len(x) for x in parts], dtype=np.int64)))
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(sizes)))


def _units(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, is a whole chunk) of every unit: runs of one class of bytes, or the whole
    chunk between white space where it holds an odd byte."""
    kind = np.concatenate(([0], _CLASS[joined]))
    edge = kind[1:] != kind[:-1]
    odd = np.flatnonzero(_ODD[joined] | _odd_pairs(joined))
    solid = (kind != 0).astype(np.int8)
    turns = np.diff(solid)
    heads, tails = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    chunk = np.unique(np.searchsorted(heads, odd, side="right") - 1)
    starts = edge & (kind[1:] != 0)
    ends = edge & (kind[:-1] != 0)
    for c in chunk.tolist():
        starts[heads[c] + 1 : tails[c]] = False
        ends[heads[c] + 1 : tails[c]] = False
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    whole = np.zeros(len(starts), dtype=bool)
    whole[np.searchsorted(starts, heads[chunk])] = True
    return starts, ends, whole


def _odd_pairs(joined: np.ndarray) -> np.ndarray:
    """The signs U+00D7 and U+00F7, which are no letters, and U+0130, whose small form is two."""
    out = np.zeros(len(joined), dtype=bool)
    lead, after = joined[:-1], joined[1:]
    out[:-1] = (lead == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (lead == 0xC4) & (after == 0xB0)
    return out


def _encoded(encode: Callable, texts: list[bytes | None], chunk: int = 1 << 18) -> Iterator[bytes]:
    """The ids of each text. A worker holds some 80 bytes for each byte that it encodes at once, on
    top of what the stages before left it, so the texts go in chunks of ``chunk`` bytes."""
    for a, b in text_chunks(texts, chunk):
        yield from encode(texts[a:b])


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``extra`` and ids (little-endian unsigned 32-bit, the end id last) of each row."""
    last = int(end_id).to_bytes(4, "little")
    names = ["doc_id", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_cache(f"tokenizer {tokenizer}", lambda: WordTokenizer(tokenizer))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = [x + last for x in _encoded(encode, part.column("text").cast(pa.binary()).to_pylist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(ids, pa.binary())], [*names, "ids"])

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", ids binary"
    return docs.select(*names, "text").mapInArrow(run, schema)


class FreeRoom:
    """Tournament tree: leaves hold the free room of the bins, each inner node the larger of
    its two children; the winner walk goes left whenever the left subtree has room."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        node = 1
        while node < self.leaves:
            node *= 2
            if self.room[node] < size:
                node += 1
        return node - self.leaves

    def take(self, slot: int, size: int) -> None:
        node = slot + self.leaves
        self.room[node] -= size
        while node > 1:
            node //= 2
            self.room[node] = max(self.room[2 * node], self.room[2 * node + 1])


def pack(sizes: list[int], capacity: int, min_cut: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length), every token of every document once."""
    whole = [[(d, at, capacity)] for d, n in enumerate(sizes) for at in range(0, n - capacity + 1, capacity)]
    rest = sorted(((n % capacity, d) for d, n in enumerate(sizes) if n % capacity), key=lambda x: (-x[0], x[1]))
    tree = FreeRoom(max(1, len(rest)), capacity)
    bins: list[list[tuple[int, int, int]]] = []
    for n, d in rest:
        slot = tree.first_fit(n)
        tree.take(slot, n)
        if slot == len(bins):
            bins.append([])
        bins[slot].append((d, sizes[d] - n, n))
    bins = _filled(bins, capacity, min_cut)
    return whole + bins


def _filled(bins: list, capacity: int, min_cut: int) -> list:
    """Moves the pieces of the least filled bins into the gaps of the others, cutting them."""
    load = lambda b: sum(p[2] for p in b)
    order = sorted(bins, key=load, reverse=True)
    full: list = []
    while len(order) > 1:
        b = order[0]
        gap = capacity - load(b)
        if gap >= min_cut:
            while gap and len(order) > 1:
                d, at, n = order[-1].pop()
                if n > gap:
                    order[-1].append((d, at + gap, n - gap))
                    n = gap
                b.append((d, at, n))
                gap -= n
                if not order[-1]:
                    order.pop()
        full.append(order.pop(0))
    return full + [s for b in order for s in _powers(b, capacity, min_cut)]


def _powers(pieces: list, capacity: int, least: int) -> Iterator[list]:
    """Cuts a part-filled sequence into sequences of powers of two, down to ``least``."""
    total = sum(p[2] for p in pieces)
    todo = list(pieces)
    while total:
        want = min(1 << (total.bit_length() - 1), capacity)
        if want < least:
            want = total
        total -= want
        out = []
        while want:
            d, at, n = todo.pop(0)
            if n > want:
                todo.insert(0, (d, at + want, n - want))
                n = want
            out.append((d, at, n))
            want -= n
        yield out


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, group_docs: int = 2048,
                   min_cut: int = 32) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A row's group is a hash of its id and its place in the input, so that repeated ids spread
    like others; the number of groups grows with the documents."""
    small_batches(docs.sparkSession)
    groups = max(1, -(-docs.count() // group_docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)).alias("part"))
    ids = token_ids(rows, tokenizer, end_id, ("part",))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("ids", "ascending")]).combine_chunks()
        part, raw = group.column("part")[0].as_py(), group.column("ids").to_pylist()
        out = []
        for k, pieces in enumerate(pack([len(x) // 4 for x in raw], capacity, min_cut)):
            at = 0
            for d, start, n in pieces:
                crc = zlib.crc32(raw[d][4 * start : 4 * (start + n)])
                out.append((d, start, n, crc, len(raw[d]) // 4, part << 32 | k, at))
                at += n
        d, *rest = (pa.array(c, pa.int64()) for c in zip(*out))
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.table([group.column("doc_id").take(d), *rest], names=names)

    return ids.groupBy("part").applyInArrow(run, PIECES)
