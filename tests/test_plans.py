"""Plan-shape checks: pruning reaches the scan, dedup aggregates partially before the
shuffle, top-k windows are limited before the shuffle, nothing is a cartesian product."""

from __future__ import annotations

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(spark, key: str) -> str:
    df = E.queries()[key](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    # host-level queries never read the page HTML; IP extraction reads one column
    assert "ReadSchema: struct<url:string>" in _plan(spark, "jn10_service_inventory")
    assert "ReadSchema: struct<text:string>" in _plan(spark, "prj9_extract_ipv4")


def test_secret_dedup_aggregates_before_shuffle(spark):
    plan = _plan(spark, "ext4_dedup_secrets")
    assert "partial_min" in plan


def test_no_cartesian_products(spark):
    for key in E.queries():
        if key.startswith("str"):
            continue
        plan = _plan(spark, key)
        assert "CartesianProduct" not in plan, key


def test_window_group_limit_for_top_k(spark):
    plan = E.queries()["win2_endpoint_examples"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan
