"""Sources, sinks, property tests and stream restart behaviour."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from surfacekit.operators import inventory as INV
from surfacekit.operators import reporting as RP
from surfacekit.sources import findings as FD
from surfacekit.sources import io
from surfacekit.sources import tables as T
from surfacekit.streaming import findings_stream as ST


def test_read_lines_bom_blank_and_source(spark, tmp_dir):
    p = os.path.join(tmp_dir, "subs.txt")
    with open(p, "wb") as f:
        f.write("﻿a.example.com\n\n   \nb.example.com  \n".encode() + b"\xff\xfebad\n")
    rows = io.read_lines(spark, p).collect()
    lines = [r.line for r in rows]
    assert lines[0] == "a.example.com" and "b.example.com" in lines and "" not in lines
    assert {r.source for r in rows} == {"subs.txt"}


def test_read_jsonl_drops_malformed(spark, tmp_dir):
    p = os.path.join(tmp_dir, "resp.jsonl")
    with open(p, "w") as f:
        f.write('{"url": "https://a", "status_code": 200, "tech": ["nginx"]}\n{broken\n'
                '{"url": "https://b", "status_code": 403}\n')
    df = io.read_jsonl(spark, p, "url string, status_code int, tech array<string>")
    assert sorted(r.url for r in df.collect()) == ["https://a", "https://b"]


def test_read_json_documents_and_flatten(spark, tmp_dir):
    d = os.path.join(tmp_dir, "docs")
    os.makedirs(d)
    with open(os.path.join(d, "scan.json"), "w") as f:
        f.write('{"url_list": [{"url": "https://x/1"}, {"url": ""}],\n "subdomains": ["a.x"],\n'
                ' "results": [{"task": {"url": "https://x/1"}, "page": {"ip": "10.0.0.1"}}]}')
    schema = ("url_list array<struct<url:string>>, subdomains array<string>, "
              "results array<struct<task:struct<url:string>, page:struct<ip:string, server:string>>>")
    docs = io.read_json_documents(spark, d, schema)
    out = {(r.kind, r.value) for r in INV.flatten_passive(docs).collect()}
    assert out == {("url", "https://x/1"), ("subdomain", "a.x"), ("scan", "https://x/1 | 10.0.0.1 | ")}


def test_read_csv_results(spark, tmp_dir):
    p = os.path.join(tmp_dir, "r.csv")
    with open(p, "w") as f:
        f.write("host,port\na,80\nb,443\n")
    assert io.read_csv_results(spark, p, "host string, port int").count() == 2


def test_write_nonempty_never_writes_empty(spark, tmp_dir):
    out = os.path.join(tmp_dir, "o")
    assert not io.write_nonempty(spark.range(0), out)
    assert not os.path.exists(out)
    assert io.write_nonempty(spark.range(3), out)
    assert spark.read.parquet(out).count() == 3


def test_append_new_twice_adds_nothing(spark, tmp_dir):
    sink = os.path.join(tmp_dir, "hosts")
    inc = spark.createDataFrame([("a",), ("b",), ("b",)], "host string")
    assert io.append_new(spark, inc, "host", sink) == 2
    assert io.append_new(spark, inc, "host", sink) == 0
    more = spark.createDataFrame([("b",), ("c",), ("c",)], "host string")
    assert io.append_new(spark, more, "host", sink) == 1
    assert sorted(r.host for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_write_by_class_master_is_union(spark, tmp_dir):
    f = FD.findings(spark, SF_SMALL).select("finding", "vuln_class")
    out = os.path.join(tmp_dir, "by_class")
    io.write_by_class(f, out)
    assert spark.read.parquet(out).count() == f.count()
    assert spark.read.parquet(os.path.join(out, "vuln_class=cves")).count() == \
        f.where(F.col("vuln_class") == "cves").count()


def test_set1_idempotent(spark):
    u = T.url_sources(spark, SF_SMALL).select("url")
    once = u.distinct()
    assert once.distinct().exceptAll(once).count() == 0 and once.count() == once.distinct().count()


def test_class_counts_sum_to_total(spark):
    rows = {r.vuln_class: r.findings for r in RP.class_counts(FD.findings(spark, SF_SMALL)).collect()}
    total = rows.pop("TOTAL")
    assert sum(rows.values()) == total


def test_ip_to_network_nested_ranges(spark):
    ranges = spark.createDataFrame([("0.0.0.0/0", "d"), ("10.0.0.0/8", "a"), ("10.1.0.0/16", "b"), ("10.1.2.3/32", "c"), ("10.1.2.128/25", "e")],
                                   "cidr string, asn string")
    ips = spark.createDataFrame([(x,) for x in ("10.1.2.3", "10.1.2.3", "10.1.2.4", "10.1.2.200", "10.9.9.9", "255.255.255.255", "0.0.0.0", "x", None)], "ip string")
    got = {r["ip"]: (r["asn"], r["prefix"]) for r in INV.ip_to_network(ips, ranges).collect()}
    assert got == {"10.1.2.3": ("c", 32), "10.1.2.4": ("b", 16), "10.1.2.200": ("e", 25), "10.9.9.9": ("a", 8),
                   "255.255.255.255": ("d", 0), "0.0.0.0": ("d", 0)}


def test_stream_restart_adds_nothing(spark):
    base = ST.work_dir(spark, "restart")
    f = FD.findings(spark, SF_SMALL).select("event_id", "finding", "vuln_class")
    path = f"{base}/in"
    f.repartition(4).write.parquet(path)
    for _ in range(2):
        s = ST.stream_findings(spark, path, f.schema)
        ST.run(ST.start_append(ST.stream_dedup(s.select("finding")), f"{base}/out", f"{base}/ckpt"))
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == f.select("finding").distinct().count()
