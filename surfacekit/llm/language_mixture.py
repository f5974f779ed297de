"""Language identification by multilingual mixture inference.

A language is a distribution of character trigrams of lower-cased text (letters kept, other
ASCII signs as blanks, hashed to a fixed number of buckets), learned from labelled documents.
A document is a mixture of languages: expectation-maximisation estimates the proportions that
make its trigrams likeliest, and the language set is the one with the best likelihood less a
penalty for each language. The largest proportion is the predicted language.

Texts that are null or hold no letter are ``und`` with score 0, as is every text when nothing
was learned. Repeated rows are predicted each; ties go to the language that sorts first. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.common import held_out, text_chunks

BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
MOST_MODEL_BYTES = 256 << 20

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]


def trigram_buckets(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every trigram of bytes that is not all blanks."""
    raw = [b" " + (t or "").lower().encode() + b" " for t in texts]
    sizes = np.array([len(r) for r in raw])
    x = _FOLD[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    text = np.repeat(np.arange(len(raw)), sizes)
    if len(x) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b, c = x[:-2], x[1:-1], x[2:]
    real = (text[:-2] == text[2:]) & ~((b == 32) & ((a == 32) | (c == 32)))
    key = ((a << np.uint32(16)) | (b << np.uint32(8)) | c) * np.uint32(0x9E3779B1)
    return text[:-2][real], (key[real] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def counts_by_language(docs: DataFrame) -> DataFrame:
    """(lang, counts): the trigrams of all rows with text and language, summed up in each task
    before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for a, b in text_chunks(texts):
                text, bucket = trigram_buckets(texts[a:b])
                names = sorted(set(langs[a:b]))
                number = np.array([names.index(x) for x in langs[a:b]])
                sums = np.bincount(number[text] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for name, row in zip(names, sums):
                    total[name] = total.get(name, 0) + row
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([r.tolist() for r in total.values()], pa.list_(pa.int64()))],
                                         ["lang", "counts"])

    def add(group: pa.Table) -> pa.Table:
        whole = np.stack(group.column("counts").to_numpy()).sum(axis=0)
        return pa.table({"lang": group.column("lang")[:1], "counts": pa.array([whole.tolist()], pa.list_(pa.int64()))})

    schema = "lang string, counts array<bigint>"
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    return known.mapInArrow(count, schema).groupBy("lang").applyInArrow(add, schema)


@dataclass(frozen=True)
class Languages:
    """Names in order and P(bucket | language), one row for each."""

    names: tuple[str, ...]
    p: np.ndarray


def learn(docs: DataFrame) -> Languages:
    """From all given rows. One row per language comes to the driver, its size checked."""
    counts = counts_by_language(docs).where(F.exists("counts", lambda c: c > 0))
    rows = counts.orderBy("lang").limit(MOST_MODEL_BYTES // (8 * BUCKETS) + 1).collect()
    if len(rows) * 8 * BUCKETS > MOST_MODEL_BYTES:
        raise ValueError(f"more languages than a model of {MOST_MODEL_BYTES} bytes holds")
    c = np.array([r["counts"] for r in rows], dtype=np.float64).reshape(len(rows), BUCKETS) + 0.5
    return Languages(tuple(r["lang"] for r in rows), c / c.sum(axis=1, keepdims=True))


def mixture(counts: np.ndarray, p: np.ndarray, start: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for many texts at once: (proportions, log-likelihood).
    Languages with a starting proportion of 0 stay out."""
    pi, total = start, counts.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        new = pi * ((counts / (pi @ p + 1e-300)) @ p.T) / total
        moved, pi = np.abs(new - pi).max(initial=0), new
        if moved < 1e-3:
            break
    return pi, (counts * np.log(pi @ p + 1e-300)).sum(axis=1)


PATIENCE = 3


def identify(counts: np.ndarray, p: np.ndarray, penalty: float) -> np.ndarray:
    """Proportions of the selected language set for each row of trigram counts. ``penalty``
    times the logarithm of the row's trigrams is the cost of a further language. Sets grow, by
    the languages' order in the full mixture, up to all of them; a row is done when none of the last
    ``PATIENCE`` sizes improved its penalised likelihood."""
    total = counts.sum(axis=1)
    cost = penalty * np.log(total + 1)
    single = counts @ np.log(p).T
    best = single.argmax(axis=1)
    out = np.eye(len(p))[best]
    # no mixture is likelier than the best language by more than this bound (the likelihood is
    # concave); where that cannot pay for a second language, one language is the selection
    gain = ((counts / p[best]) @ p.T).max(axis=1)
    todo = np.flatnonzero(total * np.log(np.maximum(gain / total, 1)) > cost)
    if not len(todo) or len(p) == 1:
        return out
    c = counts[todo]
    full, _ = mixture(c, p, np.full((len(todo), len(p)), 1 / len(p)))
    order = np.argsort(-full, axis=1, kind="stable")
    value = single[todo, best[todo]] - cost[todo]
    live, last = np.arange(len(todo)), np.ones(len(todo), dtype=np.int64)  # still growing; the size that improved last
    for n in range(2, len(p) + 1):
        live = live[n - last[live] <= PATIENCE]
        if not len(live):
            break
        allowed = np.zeros((len(live), len(p)))
        np.put_along_axis(allowed, order[live, :n], 1 / n, axis=1)
        pi, fit = mixture(c[live], p, allowed)
        gained = fit - n * cost[todo[live]]
        better = gained > value[live]
        won = live[better]
        value[won], last[won] = gained[better], n
        out[todo[won]] = pi[better]
    return out


def detect(docs: DataFrame, model: Languages, penalty: float = 2.0) -> DataFrame:
    """doc_id, lang_pred, score (its proportion) and languages (all selected, with proportions)."""
    schema = "doc_id long, held_out boolean, lang_pred string, score double, languages array<struct<lang: string, share: double>>"
    kinds = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            preds, scores, sets = [], [], []
            for a, b in text_chunks(texts, 1 << 20):
                for lo in range(a, b, 256):
                    part = texts[lo : min(b, lo + 256)]
                    ok = [bool(t) and any(map(str.isalpha, t)) and bool(model.names) for t in part]
                    text, bucket = trigram_buckets(part)
                    counts = np.bincount(text * BUCKETS + bucket, minlength=len(part) * BUCKETS).reshape(len(part), BUCKETS).astype(np.float64)
                    live = np.flatnonzero(ok)
                    pi = np.zeros((len(part), max(1, len(model.names))))
                    if len(live):
                        pi[live] = identify(counts[live], model.p, penalty)
                    for row, known in zip(pi, ok):
                        first = int(row.argmax())
                        preds.append(model.names[first] if known else "und")
                        scores.append(min(1.0, float(row[first])) if known else 0.0)
                        sets.append([{"lang": model.names[k], "share": float(row[k])} for k in np.flatnonzero(row > 1e-3)] if known else [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held"), pa.array(preds, pa.string()),
                                              pa.array(scores, pa.float64()), pa.array(sets, kinds)],
                                             ["doc_id", "held_out", "lang_pred", "score", "languages"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held"), "text")
    return rows.mapInArrow(run, schema)


def identify_languages(docs: DataFrame, penalty: float = 2.0) -> DataFrame:
    """Learns from the rows outside the held-out fold, then predicts every row."""
    return detect(docs, learn(docs.where(~held_out())), penalty)
