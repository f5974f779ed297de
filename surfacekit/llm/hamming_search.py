"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes by a learned rotation (iterative quantisation on a bounded sample).
A code is split into substrings; two codes within a Hamming radius have at least one substring
within that substring's share of the radius (pigeonhole), so an index of each substring, probed
at every value within its share, retrieves every code within the radius. Those are reranked by
their inner products in double precision.

The vectors are dealt at random into shards of bounded size, each with its own index of all
substrings; the stated queries go to every shard in blocks, and each shard returns its nearest
ones. Queries that then have fewer than ``k`` rows, although there are more candidates, are
searched again with a wider radius, at last with that of all bits. Equal vectors are one index entry that lists as many of their smallest ids as can ever be
returned, so a vector that very many rows share is one entry.

Vectors that are null, empty, of another length than most, zero, or hold null or non-finite
components take no part. Repeated ids are kept as they are; ties go to the smaller id. A query
with no other vector has no rows. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfacekit.llm.common import small_side, smallest_hashes, stored

SUB_BITS = 8


@dataclass(frozen=True)
class Codes:
    """The learned code: the sign of (vector - mean) times ``rotation``; ``radii`` are the
    substrings' shares of the Hamming radius."""

    mean: np.ndarray
    rotation: np.ndarray
    radii: tuple[int, ...]

    @property
    def radius(self) -> int:
        return sum(r + 1 for r in self.radii) - 1

    def widened(self) -> list[Codes]:
        """The same codes with the radius half-way to all bits, and with all bits."""
        bits = SUB_BITS * len(self.radii)
        steps = sorted({(self.radius + bits + 1) // 2, bits} - {self.radius})
        return [replace(self, radii=share_radius(r, len(self.radii))) for r in steps]

    def encode(self, x: np.ndarray) -> np.ndarray:
        """One byte per substring."""
        return np.packbits((x - self.mean) @ self.rotation > 0, axis=1)


def learn_rotation(x: np.ndarray, bits: int, rounds: int = 30, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Iterative quantisation: principal directions, then the rotation that brings them nearest
    to their signs. ``bits`` beyond the dimension take further random rotations' directions."""
    rng, mean = np.random.default_rng(seed), x.mean(axis=0)
    centred, parts, dim = x - mean, [], x.shape[1]
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    for at in range(0, bits, dim):
        k = min(dim, bits - at)
        base = axes[:k].T if len(axes) >= k else np.linalg.qr(rng.normal(size=(dim, k)))[0]
        v = centred @ base
        turn = np.linalg.qr(rng.normal(size=(k, k)))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.sign(v @ turn).T @ v)
            turn = (u @ w).T
        parts.append(base @ turn)
    return mean, np.concatenate(parts, axis=1)


def share_radius(radius: int, parts: int) -> tuple[int, ...]:
    """Shares with sum(share + 1) = radius + 1, as even as can be; -1: not probed."""
    low, more = divmod(radius + 1, parts)
    return tuple(low - 1 + (k < more) for k in range(parts))


def learn_codes(x: np.ndarray, bits: int, k: int, recall: float, probes: int = 256) -> Codes:
    """The rotation, and the least radius that held the ``recall`` share of the true ``k``
    nearest of ``probes`` sample vectors within the sample."""
    bits = -(-bits // SUB_BITS) * SUB_BITS
    mean, rotation = learn_rotation(x, bits)
    codes = np.packbits((x - mean) @ rotation > 0, axis=1)
    far = []
    for q in range(0, len(x), max(1, len(x) // probes)):
        score = x @ x[q]
        score[q] = -np.inf
        near = np.argpartition(-score, min(k, len(x) - 1) - 1)[:k] if len(x) > 1 else []
        far.extend(np.bitwise_count(codes[near] ^ codes[q]).sum(axis=1))
    radius = int(np.quantile(far, recall, method="higher")) if far else bits
    return Codes(mean, rotation, share_radius(min(radius, bits), bits // SUB_BITS))


class MultiIndex:
    """Index of one shard: for each substring, its vectors in order of the substring's value."""

    def __init__(self, vectors: np.ndarray, model: Codes) -> None:
        self.vectors, self.model, self.codes = vectors, model, model.encode(vectors)
        self.order = [np.argsort(c, kind="stable") for c in self.codes.T]
        self.begin = [np.searchsorted(c[o], np.arange(257)) for c, o in zip(self.codes.T, self.order)]
        masks = [[sum(1 << b for b in c) for n in range(r + 1) for c in combinations(range(SUB_BITS), n)] for r in model.radii]
        self.masks = [np.array(m, dtype=np.uint8) for m in masks]

    def within(self, code: np.ndarray) -> np.ndarray:
        """Every vector whose code is within the radius of ``code``."""
        seen = np.zeros(len(self.vectors), dtype=bool)
        for part, masks in enumerate(self.masks):
            values = (masks ^ code[part]).astype(np.int64)
            lo, hi = self.begin[part][values], self.begin[part][values + 1]
            sizes = hi - lo
            at = np.repeat(lo - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            seen[self.order[part][at]] = True
        near = np.flatnonzero(seen)
        return near[np.bitwise_count(self.codes[near] ^ code).sum(axis=1) <= self.model.radius]


def _search(model: Codes, k: int):
    def run(key: tuple, queries: pa.Table, shard: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if len(queries) and len(shard):
            matrix = lambda t: np.stack(t.column("v").to_numpy()).astype(np.float64)
            index, ids = MultiIndex(matrix(shard), model), shard.column("ids").to_pylist()
            q = matrix(queries)
            for query_id, x, code in zip(queries.column("id").to_pylist(), q, model.encode(q)):
                near = index.within(code)
                score = np.einsum("ij,j->i", index.vectors[near], x)
                if len(near) > k + 1:  # the query's own vector may be among them
                    edge = -np.partition(-score, k)[k]
                    near, score = near[score >= edge], score[score >= edge]
                hits = [(-s, i) for n, s in zip(near, score) for i in ids[n] if i != query_id]
                out += [(query_id, i, -s) for s, i in sorted(hits)[:k]]
        cols = zip(*out) if out else [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, bits: int = 64, recall: float = 0.97,
            sample: int = 20_000, shard_size: int = 16_384, query_block: int = 4_096) -> DataFrame:
    """The ``k`` nearest other vectors found for each query (all, if there are fewer), by inner
    product: query_id, rank (from 1), vec_id, score. Both tables have vec_id and embedding. The code is learned on at
    most ``sample`` vectors, those with the smallest hashes of their ids; all are indexed."""
    bad = lambda v: F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    clean = lambda df: (df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
                        .where(F.col("id").isNotNull() & (F.size("v") > 0) & ~bad(F.col("v")) & F.exists("v", lambda c: c != 0)))
    rows, asked = clean(vectors), clean(queries)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = usual["n"] if usual else 0
    rows, asked = rows.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    fitted = [v for _, v in sorted((r["id"], r["v"]) for r in smallest_hashes(rows, "id", sample).select("id", "v").collect())]
    first = Window.partitionBy("v").orderBy("id")
    same = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    classes = same.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes, asked = stored(classes), stored(asked)
    shards = max(1, -(-classes.count() // shard_size))
    model = learn_codes(np.array(fitted), bits, k, recall) if fitted else Codes(np.zeros(1), np.zeros((1, 8)), (0,))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))

    def search(codes: Codes, some: DataFrame) -> DataFrame:
        blocks = max(1, -(-some.count() // query_block))
        left = some.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", each(shards))
        right = classes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int")).withColumn("block", each(blocks))
        found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
            _search(codes, k), "query_id long, vec_id long, score double")
        return stored(found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))

    own = rows.join(asked.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.count("*").alias("own"))
    total = rows.count()
    due = asked.select("id").distinct().join(own, "id", "left").select(
        F.col("id").alias("query_id"), F.least(F.lit(k), total - F.coalesce("own", F.lit(0))).alias("due"))
    found, out = search(model, asked), None
    due = stored(due)
    for codes in model.widened():
        held = found.groupBy("query_id").agg(F.count("*").alias("held"))
        short = stored(due.join(held, "query_id", "left").where(F.coalesce("held", F.lit(0)) < F.col("due")).select("query_id"))
        if short.isEmpty():
            break
        ids = small_side(short)
        done = found.join(ids, "query_id", "left_anti")
        out = done if out is None else out.unionByName(done)
        asked, due = asked.join(ids, asked["id"] == ids["query_id"], "left_semi"), due.join(ids, "query_id", "left_semi")
        found = search(codes, asked)
    return found if out is None else out.unionByName(found)
