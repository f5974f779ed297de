"""N-gram Jaccard join: documents whose sets of word n-grams overlap enough, and the groups
that these links form.

Every n-gram is a 64-bit hash; equal sets are one node from the start. The n-grams have one
global order, rare ones first (a fixed-size frequency sketch of the whole corpus, then the
hash). Two sets that link share an n-gram among the first few of both, so a tile is one such
n-gram and one band of set sizes: linked sets are in the same band or in neighbouring ones, and
a set stands in the tile of its own band and, near the edge, in the next. In a tile, hashed bitmap signatures
bound the overlap from above by bit counts; pairs that pass are intersected exactly as sorted
arrays.

Pairs are looked at in two rounds. First each tile's nodes are held against its least node;
the components so found join most of a large group of near copies with one pair a node. Then
only tiles whose other nodes are in different components are looked at again, and there only
pairs of different components. No link between different components is left out.

Texts that are null or hold no word have an empty set and link with nothing. Repeated rows and
equal texts share a node; a null doc_id is a row like others but names no component unless
nothing else does. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.common import small_side, stored, text_chunks
from surfacekit.llm.components import components
from surfacekit.llm.words import WordHasher, grams, sequence_hash

SKETCH_BITS = 20  # counters of the frequency sketch: 2**20, 8 MB at any input size
SIGNATURE_BITS = (512, 1 << 18)  # two bits an n-gram, a power of two within these bounds
TILE_ROWS = 2_000
FIRST_TILES = 16


@dataclass(frozen=True)
class Rule:
    """Sets of ``n``-word shingles link when 100 * intersection >= ``percent`` * union."""

    n: int
    percent: int

    def prefix(self, size: int) -> int:
        """How many first n-grams of a set must hold one that a linked set's first ones hold."""
        return size - -(-self.percent * size // 100) + 1

    def bands(self, size: Column) -> Column:
        """The bands of a set: its own, and the next if a linked set can be there. A band spans
        four times the largest ratio of linked sets' sizes."""
        width = 4 * math.log(100 / self.percent)
        band = lambda c: F.floor(F.log(c.cast("double")) / width + 1e-9)
        return F.sequence(band(size), band(F.floor(size * 100 / self.percent)))


def shingle_sets(texts: list, n: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text (bytes or None)."""
    for a, b in text_chunks(texts):
        _, _, _, words, firsts = hasher(texts[a:b])
        all_grams = grams(words, n)
        for lo, hi in zip(firsts[:-1], firsts[1:]):
            if hi - lo >= n:
                yield np.unique(all_grams[lo : hi - n + 1])
            elif hi > lo:
                yield np.array([sequence_hash(words[lo:hi], n)], dtype=np.uint64)
            else:
                yield np.empty(0, dtype=np.uint64)


def _bytes(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).cast(pa.binary()).to_pylist()


def frequency_tiers(docs: DataFrame, n: int) -> np.ndarray:
    """A rank for each counter of the sketch, 0 for n-grams that are not frequent. All n-grams of
    all documents are counted; only the 2**20 sums come to the driver."""
    size, block = 1 << SKETCH_BITS, 1 << 10

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = WordHasher(lower=True), np.zeros(size, dtype=np.int64)
        for batch in batches:
            texts = _bytes(batch, "text")
            for a, b in text_chunks(texts):
                words = hasher(texts[a:b])[3]
                total += np.bincount((grams(words, n) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size)
        rows = total.reshape(-1, block)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(list(rows[used]), pa.list_(pa.int64()))], ["block", "counts"])

    def add(groups: pa.Table) -> pa.Table:
        total = np.stack(groups.column("counts").to_numpy()).sum(axis=0)
        return pa.table({"block": groups.column("block")[:1], "counts": pa.array([total.tolist()], pa.list_(pa.int64()))})

    schema = "block int, counts array<bigint>"
    parts = docs.select("text").mapInArrow(count, schema).groupBy("block").applyInArrow(add, schema)
    out = np.zeros(size)
    for k, counts in parts.collect():
        out[k * block : (k + 1) * block] = counts
    usual = np.median(out)
    spread = max(1.0, np.sqrt(usual))
    return np.floor(np.log2(np.maximum(1.0, (out - usual) / spread / 2))).clip(0, 255).astype(np.uint8)


def document_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """For each row: doc_id, row (hash of its text), size, node (hash of the set; null if
    empty), signature and the first n-grams in the global order."""
    tiers = frequency_tiers(docs, rule.n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(lower=True)
        for batch in batches:
            sizes, nodes, signatures, firsts = [], [], [], []
            for s in shingle_sets(_bytes(batch, "text"), rule.n, hasher):
                sizes.append(len(s))
                nodes.append(_node(s))
                signatures.append(signature(s))
                rank = tiers[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                firsts.append(s[np.argsort(rank, kind="stable")[: rule.prefix(len(s)) if len(s) else 0]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(signatures, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))],
                ["doc_id", "row", "size", "node", "signature", "firsts"])

    return docs.select("doc_id", "row", "text").mapInArrow(
        run, "doc_id long, row long, size long, node long, signature binary, firsts array<bigint>")


def _node(s: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None


def signature(s: np.ndarray) -> bytes:
    """A bitmap with the parity of the n-grams that hash to each bit."""
    bits = min(max(SIGNATURE_BITS[0], 1 << max(0, 2 * len(s) - 1).bit_length()), SIGNATURE_BITS[1])
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the n-grams in one set alone: the bits that differ, after the longer
    bitmap is folded onto the shorter."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def _fits(rule: Rule, x: Column, y: Column) -> Column:
    return 100 * F.least(x, y) >= rule.percent * F.greatest(x, y)


def _bounded(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sizes and bit counts allow the overlap that links them."""
    about = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"n{c}"), F.col("signature").alias(f"s{c}"))
    both = pairs.join(about("a"), "a").join(about("b"), "b").where(_fits(rule, F.col("na"), F.col("nb")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("na", "nb", "sa", "sb")]
            keep = [(100 + rule.percent) * (m + n - least_difference(x, y)) >= 2 * rule.percent * (m + n) for m, n, x, y in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) of nodes whose sets link, by exact intersection of their sorted n-grams."""
    pairs = stored(pairs)
    ends = pairs.select(F.col("a").alias("node")).distinct().unionByName(pairs.select(F.col("b").alias("node")).distinct())
    needed = stored(ends.distinct().join(nodes, "node").select("node", "rep.*"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(lower=True)
        for batch in batches:
            found = [s.tobytes() for s in shingle_sets(_bytes(batch, "text"), rule.n, hasher)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.binary())], ["node", "grams"])

    wanted = small_side(needed).select("node", F.col("doc_id").alias("id"), F.col("row").alias("r"))
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("r")))
    held = stored(texts.select("node", "text").dropDuplicates(["node"]).mapInArrow(sets, "node long, grams binary"))
    both = (pairs.join(held.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a")
            .join(held.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ga").to_pylist(), batch.column("gb").to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= rule.percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "ga", "gb").mapInArrow(check, "a long, b long")


def _tiles(sets: DataFrame, rule: Rule) -> DataFrame:
    """(tile, least, node) for every tile with two nodes or more and each node of it but the
    least. Nodes are taken once, whatever the number of their copies."""
    once = sets.where("size > 0").groupBy("node").agg(F.first("size").alias("size"), F.first("firsts").alias("firsts"))
    rows = (once.select("node", F.explode(rule.bands(F.col("size"))).alias("band"), "firsts")
            .select("node", "band", F.explode("firsts").alias("gram")).select("node", F.xxhash64("gram", "band").alias("tile")))
    shared = rows.groupBy("tile").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    return rows.join(stored(shared.select("tile", "least")), "tile").where("node != least").select("tile", "least", "node").distinct()


def _residual(tiles: DataFrame, groups: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs of tile members in different components whose sizes and bit counts allow a
    link. A tile of more than TILE_ROWS nodes is dealt over pairs of blocks of that size."""
    rooted = tiles.join(groups, "node", "left").select("tile", "node", F.coalesce("root", "node").alias("root"))
    mixed = rooted.groupBy("tile").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    rooted = stored(rooted.join(stored(mixed.select("tile", F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("blocks"))), "tile"))
    few = rooted.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("tile")), 1, FIRST_TILES).alias("tiles"))
    about = few.join(nodes.select("node", "size", "signature"), "node")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rooted.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "tile", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root")
    units = rows.join(about, "node").repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j", "node")
    return units.select("tile", "i", "j", "block", "node", "root", "size", "tiles", "signature").mapInArrow(
        _unit_pairs(rule), "a long, b long").distinct()


def _unit_pairs(rule: Rule):
    """Runs over rows sorted by unit (tile, i, j) and compares the nodes of each unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != key:
                    out += pairs(key, held)
                    held, key = [], row[:3]
                held.append(row[3:])
            yield table(out)
        yield table(pairs(key, held))

    def pairs(key: tuple, rows: list) -> Iterator[tuple[int, int]]:
        if len(rows) < 2:
            return
        block, node, root, size, tiles, marks = zip(*rows)
        node, root, size = (np.array(x, dtype=np.int64) for x in (node, root, size))
        short = min(map(len, marks)) // 8
        bits = np.stack([np.bitwise_xor.reduce(np.frombuffer(m, np.uint64).reshape(-1, short), axis=0) for m in marks])
        block = np.array(block)
        for k in range(len(rows) - 1):
            n, m = size[k], size[k + 1 :]
            least, most = np.minimum(n, m), np.maximum(n, m)
            near = (root[k + 1 :] != root[k]) & (100 * least >= rule.percent * most)
            if key[1] != key[2]:
                near &= block[k + 1 :] != block[k]
            at = np.flatnonzero(near)
            apart = np.bitwise_count(bits[k + 1 + at] ^ bits[k]).sum(axis=1)
            at = at[(100 + rule.percent) * (n + m[at] - apart) >= 2 * rule.percent * (n + m[at])] + k + 1
            for other in at.tolist():  # a pair is reported by its first common tile, as far as that is known
                common = set(tiles[k]).intersection(tiles[other])
                if not common or min(common) == key[0]:
                    yield (node[k], node[other]) if node[k] < node[other] else (node[other], node[k])

    def table(out) -> pa.RecordBatch:
        a, b = zip(*out) if (out := list(out)) else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links) of every row."""
    rule = Rule(n, percent)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
                       F.xxhash64("text").alias("row"))
    sets = stored(document_sets(docs, rule))
    nodes = stored(sets.where("size > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "row")).alias("rep"),
        F.first("size").alias("size"), F.first("signature").alias("signature")))
    tiles = stored(_tiles(sets, rule))

    stars = tiles.select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    links = stored(_verified(_bounded(stars, nodes, rule), docs, nodes, rule))
    groups = stored(components(links))

    rest = _residual(tiles, groups, nodes, rule)
    more = stored(_verified(rest, docs, nodes, rule))
    if not more.isEmpty():
        groups = stored(components(links.unionByName(more)))

    named = nodes.select("node", "doc_id").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(ids, "root").select("node", "component_id")
    return sets.select("doc_id", "size", "node").join(named, "node", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
