"""Notices wrapped to any width, against a plain reading of the lines."""

from __future__ import annotations

import random
import re
import textwrap

import pytest
from helpers import documents

from conftest import SF_MID
from surfacekit.llm import licences
from surfacekit.llm.common import table

MIT = max((t for f, t in licences.TEMPLATES if f == "mit"), key=len)
AGPL = max((t for f, t in licences.TEMPLATES if f == "agpl-3.0"), key=len)


def test_notices_of_many_lines_are_confirmed_once(spark):
    rows = []
    for k, text in enumerate((MIT, AGPL)):
        words = text.split()
        for j, lines in enumerate((15, 25, 40, len(words))):
            lines = min(lines, len(words))
            cuts = [round(i * len(words) / lines) for i in range(lines + 1)]
            wrapped = [" ".join(words[a:b]) for a, b in zip(cuts, cuts[1:])]
            rows.append((10 * k + j, "\n".join(["Ordinary words come first.", "", *wrapped, "", "x = 1"])))
    given = table(spark, SF_MID, "documents").where("doc_id >= 1000")
    docs = documents(spark, rows).unionByName(given.select("doc_id", "text", "lang", "source", "n_chars"))
    found = licences.scan(docs).where("doc_id < 1000 and confirmed").collect()
    got = sorted((r["doc_id"], r["paragraph"], r["family"], r["similarity"]) for r in found)
    assert got == [(10 * k + j, 2, f, 1.0) for k, f in enumerate(("mit", "agpl-3.0")) for j in range(4)]


def plain_spans(text: str) -> set[tuple[int, int]]:
    """(paragraph, last) by loops: each line with characters, and the runs from each line a template begins in."""
    lines = text.split("\n")
    starts = re.compile(licences._starts().replace(r"[\p{L}\p{N}]", r"[^\W_]").replace(r"[^\p{L}\p{N}]", r"[\W_]"))
    begins = lambda part: len(starts.findall(" ".join(part)))
    most = int(licences.SLACK * max(len(t.split()) for _, t in licences.TEMPLATES))
    out = {(i, i) for i, x in enumerate(lines) if x}
    for i in range(len(lines)):
        if begins(lines[i : i + 3]) > begins(lines[i + 1 : i + 3]):
            have, j = 0, i + 1
            while j < len(lines) and any(c.isalnum() for c in lines[j]) and have < most:
                have += sum(any(c.isalnum() for c in w) for w in lines[j].split())
                out.add((i, j))
                j += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_runs_are_the_plain_ones(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(25):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            text = rng.choice((MIT, AGPL, "All rights reserved.", "plain words of no notice", "released under the mit license " * 60))
            parts += textwrap.wrap(text, rng.choice((8, 20, 72))) + rng.choice(([], [""], ["--- ***"]))
        rows.append((k, "\n".join(parts)))
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, "MIT")]
    spans = licences.with_wrapped(documents(spark, rows)).select("doc_id", "paragraph", "last").collect()
    got: dict = {}
    for r in spans:
        assert (r["paragraph"], r["last"]) not in got.setdefault(r["doc_id"], set())
        got[r["doc_id"]].add((r["paragraph"], r["last"]))
    want = {i: plain_spans(t) for i, t in rows if t and plain_spans(t)}
    assert got == want
