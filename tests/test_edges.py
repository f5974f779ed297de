"""Hand-written expected results for cases that the test tables do not hold."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from surfacekit.functions import text as TX
from surfacekit.operators import endpoints as EP
from surfacekit.operators import filters as FL
from surfacekit.operators import links as LK
from surfacekit.operators import reporting as RP
from surfacekit.operators import responses as R
from surfacekit.operators import secrets as SE
from surfacekit.sources import io
from surfacekit.streaming import findings_stream as ST


def corpus(spark, *texts):
    return spark.createDataFrame([(f"u{k}", t) for k, t in enumerate(texts)], "url string, content string")


def test_two_secrets_with_one_short_digest_stay_two(spark):
    token = "ghp_" + "K" * 24
    got = SE.secret_findings(corpus(spark, f'a = "{token}000017377300"', f'b = "{token}000035883070"')).collect()
    assert len({r["match_key"] for r in got}) == 2


def test_whole_values_decide_in_the_second_scanner_merge(spark):
    name = "very_long_secret_key_name_that_goes_on_and_on_secret"
    lines = SE.second_scanner_lines(corpus(spark, f'{name} = "value-number-one"\n{name} = "value-number-two"'))
    none = spark.createDataFrame([], "clean string")
    assert SE.merge_second_scanner(none, lines).count() == 2


def test_contexts_never_show_a_neighbouring_match(spark):
    text = 'x password = "hun!ter#22"; contact ops@corp-mail.org; token = "' + "ab12" * 10 + '" end'
    f = SE.findings(SE.scan_secrets(corpus(spark, text))).collect()
    assert f and all("hun!ter" not in r["context"] and "corp-mail" not in r["context"] and "ab12" not in r["context"] for r in f)


def test_leak_scan_of_a_document_with_many_matches(spark):
    text = "\n".join(f'password = "pass-{k:06d}"; mail{k}@corp{k}.org' for k in range(16_000))
    f = SE.findings(SE.scan_secrets(corpus(spark, text, None, "")))
    assert f.count() >= 32_000


def test_long_endpoints_and_all_map_names(spark):
    long = "/api/" + "x" * 260
    got = {r[0] for r in EP.extract_endpoints(corpus(spark, f'fetch("{long}"); fetch("/api/ok")')).collect()}
    assert got == {long, "/api/ok"}
    maps = spark.createDataFrame([("m", [f"src/api{k}.js" if k % 2 else f"src/x{k}.js" for k in range(20)]), ("n", [])], "map_url string, sources array<string>")
    rows = [(r["pos"], r["rank"]) for r in EP.explode_source_map(maps).collect()]
    assert rows == [(2 * k - 1, k) for k in range(1, 11)]


def test_every_sitemap_line(spark):
    text = "\n".join(f"<url><loc>http://h/{k}</loc></url>" for k in range(120))
    docs = spark.createDataFrame([("h", "sitemap", text), ("h", "robots", "Disallow: /a\nnoise")], "host string, kind string, text string")
    assert LK.robots_paths(docs).count() == 121


def test_links_by_rfc_3986(spark):
    html = """<a href="?page=2"><a href='../c'><a href=./d><a href="e?x=1&amp;y=2#f"><a href="/r/./s/../t"><a href="//o.org/p">
      <a href="https://abs.org/q"><a href=""><a href="#top"><img src=mailto:a@b><a href="../../../z/.."><a href="..">"""
    pages = [(1, "http://h.org:8080/a/b.html?q=1", html), (2, "http://h.org/a/b", '<base href="/x/y/"><a href="k">'),
             (3, "http://h.org", '<a href="k"><a href="?z">'), (4, "http://h.org", None)]
    got = [(r["page_id"], r["url"]) for r in LK.page_links(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()]
    root = "http://h.org:8080"
    one = [f"{root}/a/b.html?page=2", f"{root}/c", f"{root}/a/d", f"{root}/a/e?x=1&y=2", f"{root}/r/t", "http://o.org/p",
           "https://abs.org/q", f"{root}/", f"{root}/"]
    assert got == [(1, u) for u in one] + [(2, "http://h.org/x/y/"), (2, "http://h.org/x/y/k"), (3, "http://h.org/k"), (3, "http://h.org/?z")]


def test_expected_paths_keep_the_port_and_one_row_a_url(spark):
    resp = spark.createDataFrame([("https://h:8443/a", 200), ("https://h:8443/docs", 404), ("https://h:8443/docs", 200)], "url string, status int")
    got = {r["path"]: (r["seen"], r["status"]) for r in R.expected_paths(resp, resp, ("/docs", "/v1")).collect()}
    assert got == {"/docs": (True, 200), "/v1": (False, None)}


def test_dotted_runs_and_names_of_many_groups(spark):
    run = ".".join(["1"] * 100_000)
    df = spark.createDataFrame([(f"{run} 1.2.3.4. 5.6.7.8..9.9.9.9 01.2.3.4 300.1.1.1",)], "t string")
    assert df.select(F.array_sort(F.array_distinct(TX.extract_ipv4("t")))).first()[0] == ["1.2.3.4", "5.6.7.8", "9.9.9.9"]
    names = spark.createDataFrame([(".".join(["a"] * 50_000),), ("a-b.c",), ("-a.b",), ("a..b",), ("a" * 64,), (None,)], "host string")
    assert FL.valid_hostnames(names).count() == 2


def test_broken_json_lines_are_the_same_for_every_column_set(spark, tmp_dir):
    lines = ['{"url": "a", "n": 1}', '{"url": broken', "", '{"url": "b", "n": "x"}', "  "]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_dir}/j")
    df = io.read_jsonl(spark, f"{tmp_dir}/j", "url string, n int")
    assert [tuple(r) for r in df.collect()] == [("a", 1)] and df.count() == 1 and df.select("url").count() == 1


def test_lines_are_stripped_of_all_white_space(spark, tmp_dir):
    spark.createDataFrame([("\t",), ("\ttwo\t",), (" one ",)], "value string").write.text(f"{tmp_dir}/l")
    assert {r["line"] for r in io.read_lines(spark, f"{tmp_dir}/l", "s").collect()} == {"one", "two"}


def test_append_new_to_a_missing_and_a_broken_sink(spark, tmp_dir):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert io.append_new(spark, rows, "k", f"{tmp_dir}/s") == 2
    assert io.append_new(spark, rows.unionByName(spark.createDataFrame([("c", 4)], "k string, v int")), "k", f"{tmp_dir}/s") == 1
    assert spark.read.parquet(f"{tmp_dir}/s").count() == 3
    spark.createDataFrame([("x",)], "value string").write.text(f"{tmp_dir}/t")
    import glob
    import os
    os.rename(glob.glob(f"{tmp_dir}/t/*.txt")[0], f"{tmp_dir}/t/part-0.parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        io.append_new(spark, rows, "k", f"{tmp_dir}/t")


@pytest.mark.parametrize("size, per_task", [(400, 64), (10, 3)])
def test_chunks_are_full_but_for_the_last_of_each_part(spark, size, per_task):
    urls = spark.range(1500).selectExpr("concat('http://h/', id) as url", "if(id % 3 = 0, 'hot', concat('h', id % 40)) as host")
    rows = RP.assign_chunks(urls, size, per_task).groupBy("host", "salt", "chunk").count().collect()
    assert max(r["count"] for r in rows) <= size and sum(r["count"] for r in rows) == 1500
    hosts: dict = {}
    for r in rows:
        hosts.setdefault(r["host"], []).append(r["count"])
    parts = {h: math.ceil(sum(c) / (size * per_task)) for h, c in hosts.items()}
    assert all(len(c) <= math.ceil(sum(c) / size) + parts[h] - 1 for h, c in hosts.items())


def test_a_failed_stream_raises(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/in")
    bad = spark.readStream.schema("id long").parquet(f"{tmp_dir}/in").select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        ST.run(ST.start_append(bad, f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))


def test_distinct_lines_across_batches(spark, tmp_dir):
    for k in range(3):
        spark.createDataFrame([("hot",)] * 50 + [(f"x{k}",), (f"y{k // 2}",)], "finding string").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    for _ in range(2):  # the second run finds nothing new
        s = spark.readStream.schema("finding string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
        ST.run(ST.start_distinct(s, "finding", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))
    got = [r["finding"] for r in spark.read.parquet(f"{tmp_dir}/out").collect()]
    assert sorted(got) == ["hot", "x0", "x1", "x2", "y0", "y1"]
