"""Fill-in-middle transformation by in-place block rotation.

A text is cut into prefix, middle and suffix at two token bounds. In one bytearray the sentinels
are put in front of the parts, and neighbouring blocks are exchanged by three reversals (each
block, then both together), which needs no second buffer per part: ``psm`` exchanges middle and
suffix, ``spm`` moves the suffix in front of all. Rotations are inverted to restore the text.

Tokens are runs of A-Z a-z and single other code points. The cuts and the form are drawn from the
first four 8-digit groups of the hex sha256 of ``<seed>:<doc_id>``. A text stays ``plain`` if it is
empty, holds a sentinel (it could not be restored), or by the draw.

Null texts count as empty; a null id draws from the seed and a colon alone; repeated rows are
transformed alike; an empty table gives no rows. Other columns than ``doc_id`` and ``text`` are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from surfacekit.llm.common import small_batches, text_chunks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
PLAIN_FROM, SPM_BELOW = 90, 20  # per cent
FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
RESTORED = f"{FORMS}, restored binary"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def token_starts(text: bytes) -> np.ndarray:
    """Byte offset of every token of a UTF-8 text."""
    raw = np.frombuffer(text, dtype=np.uint8)
    letter = _LETTER[raw]
    inner = np.concatenate(([False], letter[:-1])) & letter
    return np.flatnonzero(((raw & 0xC0) != 0x80) & ~inner)


def code_points(text: bytes | bytearray) -> int:
    return int(np.count_nonzero((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80))


def draws(seed: str, doc_id: int | None) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def rotate(buffer: bytearray, start: int, mid: int, end: int) -> None:
    """Exchanges the blocks [start, mid) and [mid, end) in place by three reversals."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    for a, b in ((start, mid), (mid, end), (start, end)):
        half = (b - a) // 2
        left, right = view[a : a + half], view[b - half : b][::-1]
        kept = left.copy()
        left[:] = right
        right[:] = kept


def rearranged(text: bytes, first: int, second: int, form: str) -> bytes:
    """The text with its parts [0, first), [first, second), [second, end) behind their sentinels
    in the order of ``form``."""
    buffer = bytearray(text)
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    at_middle, at_suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, at_middle if form == PSM else 0, at_suffix, len(buffer))
    return bytes(buffer)


def restore_text(output: bytes, form: str) -> bytes:
    """The text of an output: the rotation undone, then the sentinels taken out."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    start = output.find(SUFFIX) if form == PSM else 0
    mid = output.find(MIDDLE) if form == PSM else output.find(PREFIX)
    rotate(buffer, start, mid, len(buffer))
    at_suffix = start + len(buffer) - mid
    at_middle = start if form == PSM else buffer.find(MIDDLE)
    del buffer[at_suffix : at_suffix + len(SUFFIX)]
    del buffer[at_middle : at_middle + len(MIDDLE)]
    del buffer[: len(PREFIX)]
    return bytes(buffer)


def transformed(text: bytes, doc_id: int | None, seed: str) -> tuple[int, str, int | None, int | None, bytes]:
    """(tokens, form, code points of the prefix, of the middle, output)."""
    starts = token_starts(text)
    n = len(starts)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= PLAIN_FROM:
        return n, PLAIN, None, None, text
    bounds = [len(text) if k == n else int(starts[k]) for k in sorted((h1 % (n + 1), h2 % (n + 1)))]
    form = SPM if h4 % 100 < SPM_BELOW else PSM
    first, second = bounds
    return n, form, code_points(text[:first]), code_points(text[first:second]), rearranged(text, first, second, form)


def transform(docs: DataFrame, seed: str = "1") -> DataFrame:
    """docs(doc_id, text) -> doc_id, n, form, prefix_chars, middle_chars, output (UTF-8). Narrow."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for a, b in text_chunks(texts, 1 << 22):
                rows = [transformed(t or b"", i, seed) for t, i in zip(texts[a:b], ids[a:b])]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS binary) AS text").mapInArrow(run, FORMS)


def restore(forms: DataFrame) -> DataFrame:
    """The rows of ``transform`` with the text that output and form give back."""
    small_batches(forms.sparkSession)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kinds = batch.column("output").to_pylist(), batch.column("form").to_pylist()
            for a, b in text_chunks(texts, 1 << 22):
                back = pa.array(map(restore_text, texts[a:b], kinds[a:b]), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, back], names=[*names, "restored"])

    return forms.select(*names).mapInArrow(run, RESTORED)
