"""Registered round-trip queries for the file sources and sinks (SRC1, SRC2, SRC4, SNK1,
SNK3): each writes a table Spark derives from the driver tables into a fresh folder under
the shared checkpoint folder, reads it back through the operator, and returns the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from surfacekit.operators.classify import tag_urls
from surfacekit.plans import sqlbits as S
from surfacekit.plans import sqlfind as SF
from surfacekit.plans import sqlinfra as SI
from surfacekit.plans import sqlobs as SO
from surfacekit.plans.registry import register
from surfacekit.sources import findings as FD
from surfacekit.sources import infra as I
from surfacekit.sources import io
from surfacekit.sources import observations as O
from surfacekit.sources import tables as T
from surfacekit.streaming.findings_stream import work_dir

BOM = "﻿"


@register("src1_read_lines", S.with_(S.seed_urls_cte(), SF.FINDINGS, SF.TOOL_LOGS) + """
SELECT trim(line) AS line, 'tool_logs' AS source FROM tool_logs WHERE trim(line) <> ''""")
def q_src1(spark, d):
    base = work_dir(spark, "lines")
    logs = FD.tool_logs(spark, d)
    text = F.when(F.col("line").startswith("[INF]"), F.concat(F.lit(BOM), F.col("line"))).otherwise(F.col("line"))
    logs.select(text.alias("value")).write.text(f"{base}/logs")
    return io.read_lines(spark, f"{base}/logs", source="tool_logs")


_RESP_SCHEMA = "url string, status int, title string, tech array<string>"


@register("src2_read_jsonl", S.with_(SO.responses_cte()) + """
SELECT url, status, title, array_to_string(tech, ',') AS tech FROM responses WHERE status <> 500""")
def q_src2(spark, d):
    base = work_dir(spark, "jsonl")
    r = O.responses(spark, d)
    good = F.to_json(F.struct("url", "status", "title", "tech"))
    line = F.when(F.col("status") == 500, F.concat(F.lit('{"url": broken '), F.col("url"))).otherwise(good)
    r.select(line.alias("value")).write.text(f"{base}/resp")
    df = io.read_jsonl(spark, f"{base}/resp", _RESP_SCHEMA)
    return df.select("url", "status", "title", F.array_join("tech", ",").alias("tech"))


_BLOCK = 200


@register("src3_read_json_documents", f"""
WITH b AS (SELECT doc_id // {_BLOCK} AS block, count(*) AS documents, sum(n_chars) AS chars FROM documents WHERE doc_id IS NOT NULL GROUP BY 1)
SELECT block, documents, CAST(chars AS BIGINT) AS chars FROM b WHERE block % 3 <> 2
UNION ALL SELECT -1, count(*), NULL FROM b WHERE block % 3 = 2""")
def q_src3(spark, d):
    """Documents in blocks of ids, one JSON file a block, as an array of objects for every other one; every third file
    is cut short. Rows of the files that parse, and the number of those that do not (block -1)."""
    base = work_dir(spark, "json")
    docs = T.load(spark, d, "documents").where("doc_id is not null").select(F.floor(F.col("doc_id") / _BLOCK).alias("block"), "doc_id", "lang", "n_chars")
    blocks = docs.groupBy("block").agg(F.collect_list(F.struct("doc_id", "lang", "n_chars")).alias("entries"))
    one = F.to_json(F.struct("block", "entries"))
    text = (F.when(F.col("block") % 3 == 2, F.substring(one, 1, 40)).when(F.col("block") % 2 == 1, F.concat(F.lit(" [\n"), one, F.lit("]")))
            .otherwise(one))
    blocks.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{base}/docs")
    documents, unparsed = io.json_files(spark, f"{base}/docs", "block bigint, entries array<struct<doc_id:bigint,lang:string,n_chars:bigint>>")
    rows = documents.select("block", F.inline("entries")).groupBy("block").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))
    return rows.unionByName(unparsed.agg(F.lit(-1).cast("long").alias("block"), F.count("*").alias("documents"), F.lit(None).cast("long").alias("chars")))


@register("src4_read_csv_results", S.with_(SI.NETWORK) + "SELECT ip, port, service, version FROM services")
def q_src4(spark, d):
    base = work_dir(spark, "csv")
    I.services(spark, d).write.option("header", True).csv(f"{base}/services")
    return io.read_csv_results(spark, f"{base}/services", "ip string, port int, service string, version string")


@register("snk1_write_nonempty", S.with_(S.url_tags_cte()) + "SELECT url, tag FROM url_tags")
def q_snk1(spark, d):
    base = work_dir(spark, "nonempty")
    tags = tag_urls(T.url_corpus(spark, d)).select("url", "tag")
    io.write_nonempty(tags.where(F.lit(False)), f"{base}/empty")   # nothing written
    io.write_nonempty(tags, f"{base}/tags")
    return spark.read.parquet(f"{base}/tags")


@register("snk3_write_by_class", S.with_(S.seed_urls_cte(), SF.FINDINGS) + """
SELECT vuln_class, count(*) AS findings, count(DISTINCT finding) AS distinct_lines FROM findings GROUP BY vuln_class""")
def q_snk3(spark, d):
    base = work_dir(spark, "by_class")
    io.write_by_class(FD.findings(spark, d).select("finding", "vuln_class"), f"{base}/findings")
    master = spark.read.parquet(f"{base}/findings")
    return master.groupBy("vuln_class").agg(F.count("*").alias("findings"),
                                            F.countDistinct("finding").alias("distinct_lines"))
