"""Byte-level BPE through a sentencepiece model written from the vocabulary.

Each byte b stands as the character U+0100 + b, so that no byte is white space to the library.
Every token of the rank file becomes a piece of these characters, at its rank, with the score
-rank: the library joins the neighbours whose union scores highest, leftmost first, which is the
rank file's merge order. The normaliser is the identity without a dummy prefix. Pre-tokens are
encoded on their own; ids are turned back into bytes by the inverse of the byte mapping.

A token of the vocabulary that its own merges don't reach has its id as a whole pre-token, as in
the rank file's library; such tokens are found by encoding the vocabulary itself.

Null and empty texts have no ids and decode to nothing; repeated rows are encoded each; ids
outside the vocabulary are an error; an empty table gives no rows. Other columns than ``doc_id`` and
``text`` are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from surfacekit.llm.common import small_batches, text_chunks, worker_cache
from surfacekit.llm.unit_cache import UnitEncoder

FIRST = 0x100  # the character of byte 0
TO_CHARS = {b: FIRST + b for b in range(256)}
TO_BYTES = {FIRST + b: b for b in range(256)}
NORMAL, UNKNOWN, BPE = 1, 2, 2  # fixed values of the model format
ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, decoded binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank of a rank file (base64 token and decimal rank a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protocol buffer message: varint, 32-bit float or length-delimited."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def as_piece(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_CHARS)


def as_bytes(piece: str) -> bytes:
    return piece.translate(TO_BYTES).encode("latin-1")


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary whose ranks are 0 to n - 1. Piece n is the unknown
    piece that the format asks for; with all bytes in the vocabulary it never occurs."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must be 0 to n - 1")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a rank: {missing[:5]}")
    if len(tokens) >= 1 << 24:
        raise ValueError("scores are 32-bit floats, which hold whole numbers up to 2^24")
    pieces = [_field(1, as_piece(t).encode()) + _field(2, float(-r)) + _field(3, NORMAL) for r, t in enumerate(tokens)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN))
    trainer = _field(3, BPE) + _field(4, len(pieces)) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join([*(_field(1, p) for p in pieces), _field(2, trainer), _field(3, normaliser)])


class PieceCodec:
    """Encodes texts to ids and ids to bytes through the model of a rank file."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        from sentencepiece import SentencePieceProcessor

        ranks = read_ranks(path)
        self.model = SentencePieceProcessor(model_proto=serialised_model(ranks))
        tokens = [t for t in sorted(ranks, key=ranks.__getitem__)]
        own = self.model.encode([as_piece(t) for t in tokens], num_threads=1)
        self.whole = {as_piece(t): [k] for k, t in enumerate(tokens) if own[k] != [k]}
        self.bytes = [as_bytes(self.model.id_to_piece(k)) for k in range(len(tokens))]
        pre_token = regex.compile(pattern)
        self.units = UnitEncoder(lambda text: pre_token, self._encode_units)

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        pieces = [as_piece(u.encode()) for u in units]
        ids = self.model.encode(pieces, num_threads=1)
        return [self.whole.get(p, i) for p, i in zip(pieces, ids)] if self.whole else ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.units(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec(path: str, pattern: str) -> PieceCodec:
    return worker_cache(f"pieces {path} {pattern}", lambda: PieceCodec(path, pattern))


def encode_texts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_tokens, ids (little-endian unsigned 32-bit numbers): the
    pre-tokens that ``pattern`` finds, each encoded by the rank file at ``path``. Narrow."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in text_chunks(texts, 1 << 21):
                ids = codec.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"])

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(run, ENCODED)


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encode_texts`` with the bytes that their ids stand for."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            for a, b in text_chunks(ids, 1 << 22):
                decoded = pa.array([codec.decode(x or b"") for x in ids[a:b]], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, decoded], names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, DECODED)
