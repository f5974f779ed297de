from __future__ import annotations

import textwrap

import pytest
from helpers import documents

from conftest import SF_MID
from surfacekit.llm import licences
from surfacekit.llm.common import table

LONG = {f: t for f, t in licences.TEMPLATES if len(t) > 120 and f in ("mit", "gpl-3.0", "agpl-3.0", "bsd")}
GPL2 = ("This work is licensed under the GNU General Public License, version 2.", licences.OTHERS[1])


@pytest.fixture(scope="module")
def scanned(spark):
    rows, want = [], {}
    for k, (family, text) in enumerate(sorted(LONG.items())):
        for j, (width, sign) in enumerate(((72, ""), (76, "# "), (50, " * "))):
            lines = [sign + x for x in textwrap.wrap(text, width)]
            rows.append((10 * k + j, "\n".join(["Ordinary words come first.", sign.strip(), *lines, sign.strip(), "x = 1"])))
            want[10 * k + j] = family
    rows += [(500 + k, t) for k, t in enumerate(GPL2 + licences.OTHERS[2:])]
    rows += [(900, "Released under the MIT License.\nAll rights reserved.\nwords")]
    given = table(spark, SF_MID, "documents").where("doc_id >= 1000")
    docs = documents(spark, rows).unionByName(given.select("doc_id", "text", "lang", "source", "n_chars"))
    out = {}
    for r in licences.scan(docs).where("doc_id < 1000").collect():
        out.setdefault(r["doc_id"], []).append(r)
    return want, out


def test_wrapped_notices_are_confirmed_once(scanned):
    want, out = scanned
    got = {i: [(r["family"], r["paragraph"]) for r in out.get(i, []) if r["confirmed"]] for i in want}
    assert got == {i: [(f, 2)] for i, f in want.items()}


def test_other_versions_are_not_confirmed(scanned):
    assert [(i, r["family"]) for i, rows in scanned[1].items() if 500 <= i < 900 for r in rows if r["confirmed"]] == []


def test_notices_on_neighbouring_lines_stay_apart(scanned):
    assert sorted((r["paragraph"], r["family"]) for r in scanned[1][900] if r["confirmed"]) == [(0, "mit"), (1, "proprietary")]
