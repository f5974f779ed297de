"""Humans text, samples capped per host, own URL classes, approximate host counts."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.operators import secrets
from surfacekit.operators.aggregates import distinct_hosts_per_tag
from surfacekit.operators.classify import tag_urls
from surfacekit.operators.links import humans_fields
from surfacekit.operators.responses import top_k_per_group


def test_humans_fields_go_under_their_heading(spark):
    text = "Lead: A B\n/* team */\n Chef :\tC: D \r\nnothing\n: none\nempty:\n/*SITE*/ Standards: HTML\n/* open\nLast: x"
    docs = spark.createDataFrame([("h", "humans", text, 1), ("h", "robots", "Allow: /", 2), (None, "humans", "k: v", 3), ("e", "humans", "", 4),
                                  ("n", "humans", None, 5), ("h", "humans", "k: v", 6), ("h", "humans", "k: v", 6)], "host string, kind string, text string, section int")
    got = sorted((tuple(r) for r in humans_fields(docs).collect()), key=str)
    want = [("h", "", "lead", "A B"), ("h", "TEAM", "chef", "C: D"), ("h", "SITE", "standards", "HTML"), ("h", "", "last", "x"),
            (None, "", "k", "v"), ("h", "", "k", "v"), ("h", "", "k", "v")]
    assert got == sorted(want, key=str)
    assert humans_fields(docs.limit(0)).count() == 0


def test_sample_capped_per_host_is_the_plain_one(spark):
    rng = random.Random(3)
    rows = sorted({(rng.choice(["hot"] * 6 + ["a", "b", None]), f"u{rng.randrange(2000):04d}") for _ in range(1500)}, key=str)
    df = spark.createDataFrame(rows, "host string, url string")
    for k, most in ((10, 3), (10_000, 5), (7, 10_000)):
        seen: dict = {}
        kept = []
        for url, host in sorted((u, h or "") for h, u in rows):
            seen[host] = seen.get(host, 0) + 1
            if seen[host] <= most:
                kept.append((url, host))
        got = top_k_per_group(df, "host", [F.asc("url"), F.asc_nulls_first("host")], k, most).collect()
        assert [r["url"] for r in got] == [u for u, _ in kept[:k]]
    plan = top_k_per_group(df, "host", [F.asc("url")], 10, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "TakeOrderedAndProject" in plan


def test_own_rules_add_classes_and_change_none(spark):
    urls = spark.createDataFrame([("https://a.example/x?page=3&id=1",), ("https://a.example/y",), (None,)], "url string")
    own = rules.UrlRule("paged", r"[?&]page=[0-9]+")
    base = {tuple(r) for r in tag_urls(urls).collect()}
    assert {tuple(r) for r in tag_urls(urls, (*rules.ALL_URL_RULES, own)).collect()} == base | {("https://a.example/x?page=3&id=1", "paged")}


def test_approximate_host_counts_are_near(spark):
    tags = spark.range(60_000).select(F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("tag"),
                                      F.concat(F.lit("h"), F.floor(F.col("id") / 2).cast("string")).alias("host"))
    near = {r["tag"]: r for r in distinct_hosts_per_tag(tags, approx=True).collect()}
    for r in distinct_hosts_per_tag(tags).collect():
        assert near[r["tag"]]["urls"] == r["urls"] and abs(near[r["tag"]]["hosts"] - r["hosts"]) <= 0.15 * r["hosts"]
    assert distinct_hosts_per_tag(tags.limit(0), approx=True).count() == 0


def test_user_rules_are_checked_before_any_job_and_follow_the_library_s():
    both = secrets.with_user_rules([("Badge", r"\bBDG-[0-9]{4}\b", 2, ["bdg-"]), ("Desk", r"\bdesk [0-9]+", 4)])
    assert both[: len(rules.SECRET_RULES)] == list(rules.SECRET_RULES)
    badge, desk = both[len(rules.SECRET_RULES) :]
    assert badge.ord > max(r.ord for r in rules.SECRET_RULES) and desk.ord == badge.ord + 1 and desk.anchors == ()
    taken = rules.SECRET_RULES[0].name
    for bad in [(taken, "a", 1), ("x", "(", 1), ("x", "a*", 1), ("x", "(?=a)b", 1), ("x", r"(a)\1", 1), ("x", "a", 1, ["A"]), ("x", "a", 1, [""])]:
        with pytest.raises(ValueError):
            secrets.with_user_rules([bad])
    with pytest.raises(ValueError):
        secrets.with_user_rules([("x", "a", 1), ("x", "b", 1)])


def test_user_rules_find_what_plain_matching_finds(spark):
    texts = ["BDG-1234 and bdg-99, BDG-0001", "desk 7, Desk 8, desk 12", None, "", "xBDG-1234 BDG-12345", "\u00e9BDG-7777 desk 1"]
    corpus = spark.createDataFrame([(f"d{k}", t) for k, t in enumerate(texts)], "url string, content string")
    own = [("Badge", r"\bBDG-[0-9]{4}\b", 2, ["bdg-"]), ("Desk", r"\bdesk [0-9]+", 4)]
    got = {(r["url"], r["type"], r["idx"], r["offset"], r["raw"], r["tier"])
           for r in secrets.scan_secrets(corpus, secrets.with_user_rules(own)).collect() if r["type"] in ("Badge", "Desk")}
    want = {(f"d{k}", name, i, m.start(), m[0], tier) for k, t in enumerate(texts) for name, pattern, tier, *_ in own
            for i, m in enumerate(re.finditer(pattern, t or "", re.A))}
    assert got == want and len(got) == 6
