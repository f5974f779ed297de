"""Link scanner, scope suffixes, anchor automaton, stored statistics and plan sizes."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from surfacekit import rules
from surfacekit.operators import filters as FL
from surfacekit.operators import links as LK
from surfacekit.operators import secrets as SE
from surfacekit.operators import stat_store as SS
from surfacekit.plans import report_queries as RQ
from surfacekit.sources import tables as T


# ---------------------------------------------------------------------- EXT9
def urls(html, base="http://h.org/a/"):
    return [u for _, u in LK.links_of(base, html)]


def test_only_link_attributes_of_tags_give_links():
    assert urls('<a data-src="/no" href="/yes" formaction="/no2"><img srcset="/no3" SRC=/img?a=1&amp;b=2>') == ["http://h.org/yes", "http://h.org/img?a=1&b=2"]
    assert urls('<!-- <a href="/no"> --><a href="/y"><!-- open <a href="/no">') == ["http://h.org/y"]
    assert urls('<script src="/s.js">var x = \'<a href="/no">\';</script><style>a{b:url(href=/no)}</style><a href=/t>') == ["http://h.org/s.js", "http://h.org/t"]
    assert urls('<a title="x href=/no" href="/y">text href="/no"</a>') == ["http://h.org/y"]
    assert urls("<form action = '/f'><a\nhref\n=\n\"/n\"><A HREF='/u'>") == ["http://h.org/f", "http://h.org/n", "http://h.org/u"]
    assert urls('<script>never closed <a href="/no">') == [] and urls(None) == [] and urls("<a href") == []


def test_the_first_base_counts_and_null_pages_keep_absolute_links():
    assert urls('<base target=_x><base href="//b.org/d/"><base href="/z/"><a href="k">') == ["http://b.org/d/", "http://h.org/z/".replace("h.org", "b.org"), "http://b.org/d/k"]
    assert [u for _, u in LK.links_of(None, '<a href="https://x.org/p"><a href="k">')] == ["https://x.org/p"]


def test_links_of_long_pages_take_linear_time():
    for html in ("<a href=" * 200_000, "<!-- " * 200_000, '<a x="' * 200_000, "<script>" * 100_000, "<a " + "href " * 300_000 + ">"):
        t = time.perf_counter()
        list(LK.links_of("http://h.org/", html))
        assert time.perf_counter() - t < 20


# ---------------------------------------------------------------------- FLT2
def test_scope_by_suffixes_of_its_own_depths(spark):
    hosts = ["a.b.example.com", "EXAMPLE.com", "example.com.evil.org", "notexample.com", "x.deep.sub.org", "deep.sub.org", "sub.org", "com", "localhost", "", None, "..", "a..example.com"]
    scope = ["example.com", " Deep.Sub.org ", "localhost", None, "example.com"]
    df = spark.createDataFrame([(h, k) for k, h in enumerate(hosts)], "host string, k int")
    dom = spark.createDataFrame([(s,) for s in scope], "domain string")
    clean = {s.strip().lower() for s in scope if s}
    want = {k for k, h in enumerate(hosts) if h is not None and any(h.lower() == d or h.lower().endswith("." + d) for d in clean)}
    for splits in (1, 16):
        assert {r["k"] for r in FL.in_scope(df, "host", dom, splits=splits).collect()} == want
        assert {r["k"] for r in FL.in_scope(df, "host", dom, keep=False, splits=splits).collect()} == set(range(len(hosts))) - want
    assert FL.in_scope(df, "host", dom.limit(0)).count() == 0


def test_a_suffix_that_holds_all_hosts_is_spread(spark):
    hosts = spark.range(4000).select(F.concat(F.lit("h"), "id", F.lit(".hot.example.com")).alias("host"))
    dom = spark.createDataFrame([("example.com",)], "domain string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = (hosts.select(F.pmod(F.hash(F.lower("host")), F.lit(FL.SPLITS)).alias("k")).groupBy("k").count().collect())
        assert len(keys) == FL.SPLITS and max(r["count"] for r in keys) < 2 * 4000 / FL.SPLITS
        assert FL.in_scope(hosts, "host", dom).count() == 4000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ---------------------------------------------------------------------- EXT1
def plain_matches(texts, rule_set):
    out = []
    for url, text in texts:
        for r in rule_set:
            if r.anchors and not any(a in text.lower() for a in r.anchors):
                continue
            hits = [m for m in re.finditer(r.pattern, text, re.A) if m[0] and (not r.keep or re.search(r.keep, m[0], re.A))]
            out += [(url, r.ord, m.start(), m[0]) for m in hits]
    return sorted(out)


def user_rules(n):
    import dataclasses

    model = next(r for r in rules.SECRET_RULES if r.anchors and not r.keep)
    return [dataclasses.replace(model, ord=1000 + k, name=f"user {k}", anchors=(f"usr{k}_", f"usr{k}"), pattern=rf"usr{k}_[a-z0-9]{{6}}") for k in range(n)]


def test_user_rules_share_one_pass_of_the_text(spark):
    corpus = T.secret_corpus(spark, SF_SMALL)
    extra = spark.createDataFrame([("u1", "x usr7_abcdef usr71_abc123 USR3_abcdef usr3_zzzzzz"), ("u2", None), ("u3", "")], "url string, content string")
    texts = [tuple(r) for r in corpus.unionByName(extra).select("url", F.coalesce("content", F.lit(""))).collect()]
    both = [*rules.SECRET_RULES, *user_rules(300)]
    got = SE.scan_secrets(corpus.unionByName(extra), both).select("url", "rule_ord", "offset", "raw").collect()
    assert sorted(map(tuple, got)) == plain_matches(texts, both)
    assert {r["raw"] for r in got if r["rule_ord"] >= 1000} == {"usr7_abcdef", "usr71_abc123", "usr3_zzzzzz"}


def test_many_rules_cost_little_more_than_few(spark):
    texts = [r[0] for r in T.secret_corpus(spark, SF_SMALL).select("content").collect() if r[0]]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["u"] * len(texts)), pa.array(texts)], ["url", "content"])

    def seconds(rule_set):
        best = 1e9
        for _ in range(3):
            t = time.perf_counter()
            list(SE._scanner(rule_set, None)(iter([batch])))
            best = min(best, time.perf_counter() - t)
        return best

    assert seconds([*rules.SECRET_RULES, *user_rules(300)]) < 2 * seconds(rules.SECRET_RULES) + 0.1


# ---------------------------------------------------------------------- AGG5-AGG9
def stats(partials):
    from surfacekit.operators import reporting as RP

    return RP.surface_stats(SS.merged(partials)).first()


@pytest.fixture(scope="module")
def split_tables(spark, tmp_path_factory):
    """The small tables with each stat table in three files."""
    import os

    d = str(tmp_path_factory.mktemp("split"))
    for name in os.listdir(SF_SMALL):
        n = name.removesuffix(".parquet")
        df = spark.read.parquet(f"{SF_SMALL}/{name}")
        if n in RQ.STAT_TABLES:
            df = df.repartition(3)
            df.write.parquet(f"{d}/{name}")
        else:
            df.write.parquet(f"{d}/{name}")
    return d


def test_partials_of_single_files_merge_to_the_whole(spark, split_tables):
    whole = stats(SS.partial_stats(RQ.stat_facts(spark, T.Part(split_tables, {}))))
    ids = {n: SS.file_ids(spark, f"{split_tables}/{n}.parquet") for n in RQ.STAT_TABLES}
    assert all(len(x) == 3 for x in ids.values())
    parts = []
    for k in range(3):
        view = T.Part(split_tables, {n: [sorted(files)[k]] for n, files in ids.items()})
        parts.append(SS.partial_stats(RQ.stat_facts(spark, view)))
    assert stats(parts[0].unionByName(parts[1]).unionByName(parts[2])) == whole
    assert whole["total_urls"] > 0 and whole["secrets_found"] > 0


def test_a_store_scans_new_files_only_and_reports_read_no_corpus(spark, split_tables):
    store = RQ.stat_store(spark, split_tables)
    n = len(store.ledger.commits())
    first = RQ.surface_stats(spark, split_tables)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan and "pages.parquet" not in plan and "documents.parquet" not in plan
    assert len(RQ.stat_store(spark, split_tables).ledger.commits()) == n == 1
    before = first.first()
    extra = spark.createDataFrame([(10**6, "https://new.example.com/admin/", '<a href="/.env">x</a>')], "page_id long, url string, html string")
    extra.coalesce(1).write.mode("append").parquet(f"{split_tables}/pages.parquet")
    after = RQ.surface_stats(spark, split_tables).first()
    commits = RQ.stat_store(spark, split_tables).ledger.commits()
    assert len(commits) == 2 and commits[1].name.count("\n") == 0  # one new file
    assert after["total_urls"] > before["total_urls"] and after["secrets_found"] >= before["secrets_found"]
    assert after == stats(SS.partial_stats(RQ.stat_facts(spark, T.Part(split_tables, {}))))


# ---------------------------------------------------------------------- plans
def test_plans_stay_small(spark):
    sizes = {}
    for key, query in E.queries().items():
        if key.startswith(("str", "op")) or key == "pipeline":
            continue
        sizes[key] = len(query(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString())
    assert max(sizes.values()) < 100_000, sorted(sizes.items(), key=lambda x: -x[1])[:5]
    assert sizes["ext9_page_links"] < 50_000
