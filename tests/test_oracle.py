"""Every registered query against its DuckDB oracle on sf0.001 (row count, column names and
an order-insensitive value hash), and rows > 0 for every query."""

from __future__ import annotations

import hashlib
import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return str(int(v)) if v == int(v) else f"{v:.6g}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


def test_every_query_has_an_oracle_or_is_documented():
    library = {k for k in QUERIES if not k.startswith("op") and k != "pipeline"}
    assert library <= set(ORACLE)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[key])
    ocols = [c[0] for c in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) > 0, "vacuous query"
    assert len(rows) == len(orows)
    assert _digest(cols, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["tag", "urls", "hosts"]
