"""Cross-tokenizer alignment of a byte-level BPE (A) and a sentencepiece BPE (B), in Arrow tables.

``tokenised`` encodes every text once and stores the ids. ``all_ends`` flattens the id lists of many
documents with their parent indices, turns token byte lengths into end offsets by segmented
cumulative sums, and joins the ends of A and B (Acero, full outer) on the key (document, end):
ends that both have cut the groups, and in order of the ends every row is one link, whose tokens
are the next that end there or later. ``Table.group_by`` counts linked id pairs, Spark adds the
partial counts up (``pair_counts``).

``alignment`` gives each document its counts. Pairs are many on a large corpus and some are in
most documents, so the most frequent ones, at most ``hot_pairs``, go to all tasks and are joined
in Arrow; only links of rarer pairs are shuffled to their counts.

A text that is null, empty, or whose tokens of either side don't spell a space and the text has
no tokens. Repeated rows and ids are aligned each; null ids stay; an empty table gives no rows.
Other columns than ``doc_id`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.common import small_batches, stored, text_chunks, worker_cache
from surfacekit.llm.unit_cache import SharedUnits

HOT_PAIRS = 300_000
DOC_BITS = 40  # of the join key: document << 40 | end
BATCH_TOKENS = 1 << 18
FLUSH_PAIRS = 1 << 19
TOKENS = "doc_id long, a array<int>, b array<int>"
COUNTS = "pair long, links long"
SCORES = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, "
          "rare array<struct<pair:long,links:long>>")


def byte_alphabet() -> dict[str, int]:
    """The characters of byte-level vocabularies: printable bytes stand for themselves, the others
    in order for U+0100 and on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoders:
    """Both tokenizers, encoding by units, and the bytes of each id."""

    #: Units begin with white space (see SharedUnits). No token of A goes on from a sign to white
    #: space behind it, and none of B either: its pieces hold a space in front only, and no tab or line end.
    #: A text with other white space, which may join a unit's, is encoded by A as a whole.
    OTHER_SPACE = re.compile("[\r\v\f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

    def __init__(self, path_a: str, path_b: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        pa.set_cpu_count(1)
        a, b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        a.encode_special_tokens = True
        kind = json.loads(a.to_str())["pre_tokenizer"]
        if (kind["type"], kind["add_prefix_space"], kind["use_regex"]) != ("ByteLevel", False, True):
            raise ValueError("A must pre-tokenise by bytes, with the usual pattern and without a space in front")
        pieces = [b.id_to_piece(k) for k in range(b.get_piece_size())]
        if any(re.search(r"[^▁]▁|[ \t\n]", p) for p in pieces):
            raise ValueError("B must have no piece with white space but in front")
        self.blank = b.piece_to_id("▁")
        alphabet, vocabulary = byte_alphabet(), a.get_vocab(with_added_tokens=False)
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            spelled[k] = bytes(map(alphabet.__getitem__, token))
        self.bytes_a = pa.array(spelled, pa.binary())
        self.bytes_b = pa.array([bytes([int(p[3:5], 16)]) if b.is_byte(k) else b"" if b.is_control(k) or b.is_unknown(k)
                                 else p.replace("▁", " ").encode() for k, p in enumerate(pieces)], pa.binary())
        self.model_a, self.model_b = a, b
        self.units = SharedUnits([self._encode_a, self._encode_b])

    def _encode_a(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model_a.encode_batch_fast(units, add_special_tokens=False)]

    def _encode_b(self, units: list[str]) -> list[list[int]]:
        """The model puts a space in front, which is a unit's own first space or has to go."""
        own = [u[:1] == " " for u in units]
        found = self.model_b.encode([u[1:] if x else u for u, x in zip(units, own)], num_threads=1)
        return [([self.blank] if len(u) == 1 else i) if x else i[1:] for u, x, i in zip(units, own, found)]

    def __call__(self, texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
        """List arrays of the ids of A and of B, both empty where a text isn't spelled alike."""
        spaced = [f" {t}".encode() if t else b"" for t in texts]
        want = pa.array(spaced, pa.large_binary())
        a, b = (id_lists(*x) for x in self.units(spaced))
        if odd := [k for k, t in enumerate(texts) if t and self.OTHER_SPACE.search(t)]:
            own = self._encode_a([f" {texts[k]}" for k in odd])
            place = np.arange(len(texts))
            place[odd] = len(texts) + np.arange(len(odd))
            a = pa.concat_arrays([a, pa.array(own, a.type)]).take(pa.array(place))
        same = pc.and_(pc.equal(spelling(a, self.bytes_a), want), pc.equal(spelling(b, self.bytes_b), want))
        none = pa.scalar([], a.type)
        return pc.if_else(same, a, none), pc.if_else(same, b, none)


def id_lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids, pa.int32()))


def spelling(lists: pa.Array, table: pa.Array) -> pa.Array:
    """The bytes of each list of ids, joined."""
    pieces = pa.LargeListArray.from_arrays(lists.offsets.cast(pa.int64()), table.take(lists.values).cast(pa.large_binary()))
    return pc.binary_join(pieces, pa.scalar(b"", pa.large_binary()))


def _encoders(paths: tuple[str, str]) -> Encoders:
    return worker_cache(f"encoders {paths}", lambda: Encoders(*paths))


def tokenised(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, a, b: the ids of a space and the text by A, of the text by B
    (which puts that space itself); empty where there is nothing to align. Narrow."""
    small_batches(docs.sparkSession)
    paths = (path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(paths)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in text_chunks(texts):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *encoders(texts[a:b])], names=["doc_id", "a", "b"])

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(run, TOKENS)


def ends(lists: pa.Array, table: pa.Array, name: str) -> pa.Table:
    """A row for each token: its key (document << 40 | end offset), id, and place among all tokens."""
    parent = pc.list_parent_indices(lists).cast(pa.int64())
    ids = lists.flatten()
    running = pc.cumulative_sum(pc.binary_length(table).cast(pa.int64()).take(ids))
    before = pa.concat_arrays([pa.array([0], pa.int64()), running]).take(lists.offsets)  # bytes before each document
    end = pc.subtract(running, before.take(parent))
    return pa.table({"key": pc.bit_wise_or(pc.shift_left(parent, DOC_BITS), end), name: ids, f"at_{name}": pa.array(np.arange(len(ids)))})


def all_ends(a: pa.Array, b: pa.Array, encoders: Encoders) -> pa.Table:
    """The ends of both sides' tokens in order, joined where they meet: key, a, at_a, b, at_b."""
    both = ends(a, encoders.bytes_a, "a").join(ends(b, encoders.bytes_b, "b"), "key", join_type="full outer", use_threads=False)
    return both.take(pc.sort_indices(both["key"])).combine_chunks()


def links_of(both: pa.Table) -> pa.Table:
    """links(doc, pair) in order: at each end the tokens that end there or next; pair is a's id << 32 | b's."""
    ids = [pc.fill_null_backward(both[x]).cast(pa.int64()) for x in "ab"]
    return pa.table({"doc": pc.shift_right(both["key"], DOC_BITS), "pair": pc.bit_wise_or(pc.shift_left(ids[0], 32), ids[1])})


def groups_of(both: pa.Table, a: pa.Array, b: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The groups of each document as text, and their numbers."""
    cuts = both.filter(pc.and_(pc.is_valid(both["at_a"]), pc.is_valid(both["at_b"])))
    doc = pc.shift_right(cuts["key"], DOC_BITS)
    joined = [id_texts(lists, cuts[f"at_{x}"]) for x, lists in (("a", a), ("b", b))]
    texts = pc.binary_join_element_wise(*joined, pa.scalar("|", pa.large_string()))
    counts = np.bincount(doc.to_numpy(), minlength=len(a))
    whole = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts)))), texts)
    return pc.binary_join(whole, pa.scalar(";", pa.large_string())), pa.array(counts, pa.int64())


def id_texts(lists: pa.Array, last: pa.ChunkedArray) -> pa.Array:
    """The decimal ids of each group of tokens, ``last`` being the places of the groups' last tokens."""
    texts = lists.flatten().cast(pa.large_string())
    offsets = np.concatenate(([0], last.to_numpy() + 1))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), texts), pa.scalar(",", pa.large_string()))


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about a million tokens; a longer document has one of its own."""
    sizes = pc.add(pc.list_value_length(batch.column("a")), pc.list_value_length(batch.column("b"))).to_pylist()
    start = total = 0
    for k, n in enumerate(sizes):
        if k > start and total + n > BATCH_TOKENS:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def _lists(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A list column of its own, from offset 0."""
    lists = batch.column(name)
    return pa.ListArray.from_arrays(pc.subtract(lists.offsets, lists.offsets[0]), lists.flatten().cast(pa.int32()))


def _summed(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("links", "sum")]).rename_columns(["pair", "links"])


def pair_counts(tokens: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """tokens(a, b) -> pair, links: corpus-wide number of links of each pair of ids (a << 32 | b)."""
    paths = (path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(paths)
        partial: list[pa.Table] = []
        for batch in batches:
            for part in _parts(batch):
                links = links_of(all_ends(_lists(part, "a"), _lists(part, "b"), encoders))
                partial.append(links.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "links"]))
                if sum(t.num_rows for t in partial) > FLUSH_PAIRS:
                    yield from _summed(partial).to_batches()
                    partial = []
        if partial:
            yield from _summed(partial).to_batches()

    return tokens.select("a", "b").mapInArrow(run, COUNTS).groupBy("pair").agg(F.sum("links").alias("links"))


def with_best(counts: DataFrame) -> DataFrame:
    """Adds whether a pair's count is the highest of its B id."""
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    top = counts.groupBy(b.alias("b")).agg(F.max("links").alias("top"))
    return counts.withColumn("b", b).join(top, "b").select("pair", "links", (F.col("links") == F.col("top")).alias("best"))


def frequent(counts: DataFrame, most: int) -> tuple[pa.Table, int]:
    """(pairs with at least so many links, that number): the least power of two that leaves at
    most ``most`` pairs, found from the number of pairs of each power."""
    power = F.floor(F.log2("links")).cast("int")
    sizes = dict(counts.groupBy(power.alias("power")).count().collect())
    total, least = 0, max(sizes, default=-1) + 1
    while least > 0 and total + sizes.get(least - 1, 0) <= most:
        least -= 1
        total += sizes.get(least, 0)
    return counts.where(F.col("links") >= 1 << least).toArrow(), 1 << least


def scored(tokens: DataFrame, counts: pa.Table, path_a: str, path_b: str) -> DataFrame:
    """tokens(row, doc_id, a, b) -> one row each with its numbers by ``counts``(pair, links, best), and
    in ``rare`` the links of pairs that it lacks."""
    paths, hot = (path_a, path_b), tokens.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = _encoders(paths)
        for batch in batches:
            for part in _parts(batch):
                yield _scores(part, hot.value, encoders)

    return tokens.select("row", "doc_id", "a", "b").mapInArrow(run, SCORES)


def _scores(part: pa.RecordBatch, counts: pa.Table, encoders: Encoders) -> pa.RecordBatch:
    a, b = _lists(part, "a"), _lists(part, "b")
    both = all_ends(a, b, encoders)
    groups, n_groups = groups_of(both, a, b)
    own = links_of(both).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "times"])
    known = own.join(counts, "pair", join_type="left outer", use_threads=False).combine_chunks()
    times, count = known["times"], pc.fill_null(known["links"], 0)
    known = known.append_column("sum", pc.multiply(times, count)).append_column("hits", pc.multiply(times, pc.fill_null(known["best"], False).cast(pa.int64())))
    total = known.group_by("doc", use_threads=False).aggregate([("times", "sum"), ("sum", "sum"), ("hits", "sum")])
    place = total["doc"].to_numpy()

    def dense(name: str) -> pa.Array:
        out = np.zeros(part.num_rows, dtype=np.int64)
        out[place] = total[name].to_numpy()
        return pa.array(out)

    rare = known.filter(pc.is_null(known["links"])).sort_by("doc").combine_chunks()
    sizes = np.bincount(rare["doc"].to_numpy(), minlength=part.num_rows)
    pairs = pa.StructArray.from_arrays([rare[c].combine_chunks() for c in ("pair", "times")], names=["pair", "links"])
    rare = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pairs)
    columns = [part.column("row"), part.column("doc_id"), pc.list_value_length(a).cast(pa.int64()), pc.list_value_length(b).cast(pa.int64()), n_groups,
               dense("times_sum"), dense("hits_sum"), dense("sum_sum"), groups.cast(pa.string()), rare]
    return pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "rare"])


def alignment(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (text
    ``a1,a2|b1;a3|b2``): tokens and groups of each document, its links, how many of them are their
    B id's most frequent pair, and the sum of their pairs' counts."""
    tokens = stored(tokenised(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()))
    counts = stored(with_best(pair_counts(tokens, path_a, path_b)))
    hot, least = frequent(counts, hot_pairs)
    found = scored(tokens, hot, path_a, path_b)
    if least > 1:
        found = _with_rare(stored(found), counts.where(F.col("links") < least))
    return found.drop("row", "rare")


def _with_rare(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds what the links in ``rare`` count. A pair here is in fewer documents than any frequent one."""
    links = found.select("row", F.explode("rare").alias("x")).select("row", F.col("x.pair").alias("pair"), F.col("x.links").alias("times"))
    more = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("links")).alias("more_sum"))
    total = found.join(more, "row", "left")
    for name, part in (("n_best", "more_best"), ("count_sum", "more_sum")):
        total = total.withColumn(name, F.col(name) + F.coalesce(F.col(part), F.lit(0)))
    return total.drop("more_best", "more_sum")
