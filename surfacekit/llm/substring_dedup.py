"""Substring dedup: words covered by a window of ``window`` words that also starts elsewhere
are removed, judged on the input by FM-indexes.

Documents do not meet every index: a window's *anchor*, the least hash among its ``gram``-word
n-grams, is the same wherever the window stands, so shards are dealt by anchor. A run of windows
with one anchor is a *segment*. The texts that a task reads are cut into *bundles* of a bounded number of
segments; equal segments of a bundle are one row, with the places of its members, before they are
shuffled. Anchors that occur once are dropped; equal segments stand in the index twice at most. Each
shard, of a bounded number of words, builds the FM-index of its segments and streams the segments
through it by backward search; spans of ``window`` words or more with two occurrences are reported.
The segments of a bundle meet again with their spans, and one row a text comes out of it. The windows of an anchor with more than ``hot``
different segments (a passage that very many documents share, each with its own surroundings)
are dealt one by one instead, by the hash of the window, so that no shard gets them all.

Words and texts are compared by 64-bit hashes. Texts that are null or have no words give zero
words and the digest of the empty text. Equal texts are handled once and each row gets the
result, so repeated rows and ids remove each other's words. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.common import small_side, stored, text_chunks
from surfacekit.llm.fm_index import FMIndex, repeated_spans
from surfacekit.llm.words import WordHasher, grams, range_hashes


BROADCAST_ITEMS = 400_000


def _bytes(column: pa.Array) -> list:
    return column.cast(pa.binary()).to_pylist()


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each position on, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out, have = np.minimum(out[: len(out) - step], out[step:]), have + step
    return out


def anchored_segments(words: np.ndarray, firsts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, first word in the text, windows, first word in ``words``) of each segment:
    consecutive windows of one text whose anchor stands at the same place. Equal windows of one
    text are in different segments, so an anchor of one segment in all has no repeats."""
    none = tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    if len(words) < window:
        return none
    every = grams(words, gram)
    anchor = sliding_min(every, window - gram + 1)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    at = np.flatnonzero(text[: len(anchor)] == text[window - 1 :])
    if not len(at):
        return none
    here, before = at[1:], at[:-1]
    new = (here - before != 1) | (text[here] != text[before]) | (anchor[here] != anchor[before]) | (every[before] == anchor[before])
    start = np.flatnonzero(np.concatenate(([True], new)))
    first = at[start]
    return text[first], anchor[first], first - firsts[text[first]], np.diff(np.append(start, len(at))), first


_SPAN = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])
_MEMBER = pa.struct([("row", pa.int64()), ("off", pa.int32())])
_SEGMENT = "bundle long, row long, anchor long, seg long, off int, windows int, copies long, others array<struct<row:long,off:int>>"


def _bundled(bundle: int, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """A bundle's equal segments as one row: the first one's place, how many there are, the others' places."""
    row, anchor, seg, off, count, times = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(seg, kind="stable")
    row, anchor, seg, off, count, times = (c[order] for c in (row, anchor, seg, off, count, times))
    new = np.concatenate(([True], (seg[1:] != seg[:-1]) | (anchor[1:] != anchor[:-1])))
    first = np.flatnonzero(new)
    more = np.diff(np.append(first, len(seg))) - 1
    members = pa.StructArray.from_arrays([pa.array(row[~new], pa.int64()), pa.array(off[~new], pa.int32())], fields=list(_MEMBER))
    others = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(more))), pa.int32()), members, mask=pa.array(more == 0))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(first), bundle), pa.int64()), pa.array(row[first], pa.int64()), pa.array(anchor[first].view(np.int64), pa.int64()),
         pa.array(seg[first].view(np.int64), pa.int64()), pa.array(off[first], pa.int32()), pa.array(count[first], pa.int32()),
         pa.array(np.add.reduceat(times, first), pa.int64()), others],
        ["bundle", "row", "anchor", "seg", "off", "windows", "copies", "others"])


def segment_table(texts: DataFrame, window: int, gram: int, bundle: int) -> DataFrame:
    """The segments of every text; seg is a segment's words' hash. A task reads texts until they have
    ``bundle`` segments, and equal ones among these are one row: (row, off) of the first, (row, off) of
    the others (null: none), copies in all. Equal texts of one batch are one row, with their number. All
    segments of a text are in one bundle; its number tells the task and the bundle in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            rows, at, times = np.unique(batch.column("row").to_numpy(), return_index=True, return_counts=True)
            values = _bytes(batch.column("text").take(pa.array(at)))
            for a, b in text_chunks(values):
                _, _, _, words, firsts = hasher(values[a:b])
                text, anchor, off, count, first = anchored_segments(words, firsts, window, gram)
                if not len(text):
                    continue
                seg = range_hashes(words, first, first + count + window - 1)
                held.append((rows[a:b][text], anchor, seg, off, count, times[a:b][text]))
                size += len(text)
                if size >= bundle:
                    yield _bundled(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield _bundled(number, held)

    return texts.select("row", "text").mapInArrow(run, _SEGMENT)


def _cut(window: int):
    """Cuts the words of the listed segments out of their texts; hot ones window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            out: list[tuple] = []
            for text, wanted in zip(_bytes(batch.column("text")), batch.column("wanted").to_pylist()):
                joined, starts, ends, words, _ = hasher([text])
                joined = joined.tobytes()
                for w in wanted:
                    at, n = w["off"], w["windows"]
                    if w["hot"]:
                        froms = np.arange(at, at + n)
                        keys = range_hashes(words[at : at + n + window - 1], froms - at, froms - at + window).view(np.int64)
                        out += [(int(k), int(k), w["anchor"], w["seg"], int(i - at), w["copies"], joined[starts[i] : ends[i + window - 1]])
                                for i, k in zip(froms, keys)]
                    else:
                        out.append((w["anchor"], w["seg"], w["anchor"], w["seg"], 0, w["copies"], joined[starts[at] : ends[at + n + window - 2]]))
                if len(out) > 5000:
                    yield _rows(out)
                    out = []
            yield _rows(out)

    return run


_CUT = [("home", pa.int64()), ("part", pa.int64()), ("anchor", pa.int64()), ("seg", pa.int64()), ("shift", pa.int32()),
        ("copies", pa.int64()), ("words", pa.binary())]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    cols = zip(*out) if out else [[]] * len(_CUT)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _CUT)], [n for n, _ in _CUT])


def _shard(window: int, gram: int):
    """Builds the FM-index of one shard's parts and reports the repeated spans of each part."""

    def run(table: pa.Table) -> pa.Table:
        homes, parts, copies = (table.column(c).to_numpy() for c in ("home", "part", "copies"))
        texts = table.column("words").to_pylist()
        _, _, _, words, firsts = WordHasher()(texts)
        symbols = np.unique(words, return_inverse=True)[1] + 1
        starts, ends = firsts[:-1], firsts[1:]
        twice = np.flatnonzero(copies >= 2)
        pieces = np.concatenate((np.arange(len(texts)), twice))
        sizes = (ends - starts)[pieces] + 1
        line = np.zeros(int(sizes.sum()), dtype=np.int64)  # the parts, each followed by a separator
        goes = np.cumsum(sizes) - sizes
        within = np.arange(len(line)) - np.repeat(goes, sizes)
        real = within < np.repeat(sizes - 1, sizes)
        line[real] = symbols[(np.repeat(starts[pieces], sizes) + within)[real]]
        starts = goes[: len(texts)]
        ends = starts + sizes[: len(texts)] - 1
        part, first, last = repeated_spans(FMIndex(line, 2 * window, 1 << (window // 2).bit_length() - 1), line, starts, ends, window)
        return pa.table({"home": homes[part], "part": parts[part],
                         "lo": (first - starts[part]).astype(np.int32), "hi": (last - starts[part] + 1).astype(np.int32)})

    return run


def repeated_intervals(docs: DataFrame, window: int, gram: int, hot: int, shard_words: int, bundle: int) -> DataFrame:
    """(row, spans): the repeated word intervals of each text that has any."""
    table = segment_table(docs, window, gram, bundle)
    anchors = stored(table.groupBy("anchor").agg(F.sum("copies").alias("n")).where("n > 1").select("anchor"))
    held = stored(table.join(anchors, "anchor"))
    segs = held.groupBy("anchor", "seg").agg(F.sum("copies").alias("copies"), F.first("row").alias("row"),
                                             F.first("off").alias("off"), F.first("windows").alias("windows"))
    many = segs.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor", F.lit(True).alias("hot"))
    segs = segs.join(many, "anchor", "left")
    wanted = stored(segs.groupBy("row").agg(F.collect_list(F.struct(
        "anchor", "seg", "off", "windows", "copies", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted")))
    marked = docs.select("row", "text").join(_checked(wanted, "wanted"), "row")
    texts = marked.dropDuplicates(["row"]).select("text", "wanted")
    kinds = "home long, part long, anchor long, seg long, shift int, copies long, words binary"
    cut = stored(texts.mapInArrow(_cut(window), kinds))
    parts = cut.groupBy("home", "part").agg(F.sum("copies").alias("copies"), F.first("words").alias("words"))
    total = cut.agg(F.coalesce(F.sum(F.length("words")), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // (6 * shard_words)))
    spans = (parts.withColumn("shard", F.pmod(F.xxhash64("home"), F.lit(shards)))
             .groupBy("shard").applyInArrow(_shard(window, gram), "home long, part long, lo int, hi int"))
    found = cut.select("home", "part", "anchor", "seg", "shift").join(spans, ["home", "part"]).groupBy("anchor", "seg").agg(
        F.min(F.col("lo") + F.col("shift")).alias("lo"), F.max(F.col("hi") + F.col("shift")).alias("hi"))
    return _of_texts(held, stored(found))


def _of_texts(held: DataFrame, found: DataFrame) -> DataFrame:
    """(row, spans) of each text, from the span of each of its segments: a segment has fewer than two
    windows' words, so its repeated windows overlap and are one span. The members of a bundle's segments
    are dealt out within the bundle, and a text of several bundles (with equal texts) is one row."""
    places = held.select("bundle", "anchor", "seg", "row", "off", "others").join(small_side(found, BROADCAST_ITEMS), ["anchor", "seg"])
    texts = places.select("bundle", "row", "off", "others", "lo", "hi").groupBy("bundle").applyInArrow(
        _texts_of_bundle, "row long, spans array<struct<lo:int,hi:int>>")
    return texts.groupBy("row").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def _texts_of_bundle(table: pa.Table) -> pa.Table:
    """The united spans of each text of a bundle."""
    row, off, lo, hi = (table.column(c).to_numpy().astype(np.int64) for c in ("row", "off", "lo", "hi"))
    others = table.column("others").combine_chunks()
    members = others.flatten()
    more = pc.fill_null(pc.list_value_length(others), 0).to_numpy(zero_copy_only=False)
    seg = np.concatenate((np.arange(len(row)), np.repeat(np.arange(len(row)), more)))
    row = np.concatenate((row, members.field("row").to_numpy()))
    off = np.concatenate((off, members.field("off").to_numpy()))
    row, lo, hi = united(row, off + lo[seg], off + hi[seg])
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    spans = pa.StructArray.from_arrays([pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], fields=list(_SPAN))
    return pa.table({"row": row[first], "spans": pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), spans)})


def united(row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, lo, hi) of the unions of overlapping or touching intervals of a row, in order."""
    order = np.lexsort((lo, row))
    row, lo, hi = row[order], lo[order], hi[order]
    new = np.concatenate(([True], row[1:] != row[:-1]))
    apart = (np.cumsum(new) - 1) * (int(hi.max()) + 1)  # rows one after the other on a line, with a gap
    reach = np.maximum.accumulate(hi + apart)
    start = np.flatnonzero(np.concatenate(([True], (lo + apart)[1:] > reach[:-1])))
    return row[start], lo[start], (reach - apart)[np.append(start[1:], len(row)) - 1]


def _split(text: bytes | None) -> list[bytes]:
    """bytes.split() parts at blank, tab, LF, VT, FF and CR alone."""
    return (text or b"").split()


def _removed(text: str, carried: list[str]):
    """Applies each row's spans; a text that loses nothing stays as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield part(batch.slice(at, 1000))

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_words, n_removed, digests = [], [], [], []
        for value, spans in zip(_bytes(batch.column(text)), batch.column("spans").to_pylist()):
            words = left = _split(value)
            if spans:
                keep = np.ones(len(words), dtype=bool)
                for s in spans:
                    keep[s["lo"] : s["hi"]] = False
                left = [w for w, ok in zip(words, keep) if ok]
            out = b" ".join(left)
            texts.append(value if len(left) == len(words) else out)
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            digests.append(hashlib.sha256(out).hexdigest())
        columns = {c: batch.column(c) for c in carried} | {
            text: pa.array(texts, pa.binary()).cast(pa.string()), "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _checked(df: DataFrame, items: str) -> DataFrame:
    """For broadcast only up to a checked number of list items (about 30 bytes each)."""
    total = df.agg(F.coalesce(F.sum(F.size(items)), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= BROADCAST_ITEMS else df


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 12, hot: int = 2000, shard_words: int = 500_000,
                   bundle: int = 1 << 17) -> DataFrame:
    """``docs`` with its repeated words taken out of ``text`` (a text that loses words is then
    its kept words joined by one blank), and n_words, n_removed and kept_sha256 (of the kept
    words joined by one blank). Columns of these three names are replaced."""
    docs = docs.drop("n_words", "n_removed", "kept_sha256")
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"
    inner = inner.withColumn("row", F.xxhash64(text))
    spans = repeated_intervals(inner.select("row", F.col(text).alias("text")), window, gram, hot, shard_words, bundle)
    whole = inner.join(_checked(stored(spans), "spans"), "row", "left").drop("row")
    schema = inner.drop("row").withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept_sha256": F.lit("")}).schema
    out = whole.mapInArrow(_removed(text, [c for c in inner.columns if c != "row"]), schema)
    return out.toDF(*names, "n_words", "n_removed", "kept_sha256")
