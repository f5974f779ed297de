"""Scanner findings, phase results and tool logs derived from ``events``.

findings: one line per event, '[<template>] [<severity>] <target>', where the target is
the seeded URL of the page numbered like the event's user (or 'user-<id>' without one);
lines repeat by design so deduplication has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.sources import tables as T

SEVERITIES = ("info", "low", "medium", "high", "critical")
# finding classes: the report classes, then the classes confirmed per URL bucket
FINDING_CLASSES = ("cves", "misconfigurations", "default_logins", "takeovers", "exposures",
                   "open_redirects", "xss_vulnerabilities", "sqli_vulnerabilities",
                   "ssrf_vulnerabilities", "idor_vulnerabilities", "ssti_vulnerabilities",
                   "lfi_param_vulns", "cors_param_vulns", "rce_param_vulns", "debug_param_vulns")
CHUNK = 400


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.pmod(idx, F.lit(len(values))) + 1).cast("int"))


def findings(spark, d, load=T.load, pages: str | None = None) -> DataFrame:
    """findings(event_id, finding, url, vuln_class, severity, phase, batch_id, ts). ``load``
    reads the events, as a table or as a stream; ``pages`` is the folder of the pages if not ``d``."""
    ev = load(spark, d, "events")
    seed = T.seed_urls(spark, pages or d).select(F.col("page_id").alias("user_id"), F.col("url"))
    e = ev.join(seed, "user_id", "left")
    sev = _pick(SEVERITIES, F.col("event_id"))
    target = F.coalesce(F.col("url"), F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    return e.select(
        "event_id",
        F.concat(F.lit("["), F.col("event_type"), F.lit("] ["), sev, F.lit("] "), target).alias("finding"),
        target.alias("url"),
        _pick(FINDING_CLASSES, F.floor(F.col("event_id") / 5)).alias("vuln_class"),
        sev.alias("severity"),
        F.concat(F.lit("sweep-"), F.col("event_type")).alias("phase"),
        F.floor(F.col("event_id") / CHUNK).cast("bigint").alias("batch_id"),
        "ts", "value")


def phase_results(spark, d) -> DataFrame:
    """phase_results(phase, success, findings, elapsed, error): one phase per
    (event_type, hour)."""
    ev = T.load(spark, d, "events")
    sev = _pick(SEVERITIES, F.col("event_id"))
    g = ev.groupBy(F.col("event_type"), F.date_format("ts", "yyyy-MM-dd HH").alias("hour")).agg(
        F.sum("value").alias("v"), F.sum(F.when(sev.isin("high", "critical"), 1).otherwise(0)).alias("n"),
        F.min("props").alias("p"))
    ok = F.col("event_type") != "error"
    return g.select(F.concat("event_type", F.lit("@"), "hour").alias("phase"), ok.alias("success"),
                    F.col("n").cast("bigint").alias("findings"), F.col("v").cast("int").alias("elapsed"),
                    F.when(~ok, F.concat(F.lit("[WRN] retry budget spent\nexit status 1: props "), F.col("p")))
                    .alias("error"))


def tool_logs(spark, d) -> DataFrame:
    """tool_logs(stage, line): a scanner log line per event."""
    f = findings(spark, d)
    line = (F.when((F.col("severity") == "info") & (F.col("value") > 45), F.lit("[ERR] HTTP 429 Too Many Requests"))
            .when(F.col("severity") == "info", F.concat(F.lit("[INF] scanning "), F.col("url")))
            .when(F.col("severity") == "low", F.concat(F.lit("[WRN] Rate Limit reached for "), F.col("url")))
            .when(F.col("value") < 1, F.lit("invalid semicolon in query"))
            .when(F.col("value") < 2, F.lit("   "))
            .otherwise(F.col("finding")))
    return f.select(F.col("phase").alias("stage"), line.alias("line"))
