"""Registered streaming queries (STR1-STR7): each streams the files of the given tables, or files that
arrive one slot after the other, runs to completion with ``availableNow``, and returns the batch
read of the sink. Jobs have names, so a query that is called again resumes its job. Oracles are
the equivalent batch statements."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.operators import secrets as SE
from surfacekit.plans import sqlbits as S
from surfacekit.plans import sqlfind as SF
from surfacekit.plans.registry import register
from surfacekit.plans.secret_queries import hits_cte
from surfacekit.sources import findings as FD
from surfacekit.sources import tables as T
from surfacekit.streaming import findings_stream as ST

# Arrivals: eight days of events a slot, from the first day of the event tables on; every fifth event
# arrives with the next slot.
FIRST_DAY, DAYS, SLOTS = "2024-01-01", 8, 4
DELAY = 2 * 86_400


def arrival_slot():
    by_day = F.floor(F.datediff(F.col("ts").cast("date"), F.lit(FIRST_DAY).cast("date")) / DAYS)
    return F.least(F.greatest(by_day, F.lit(0)) + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0), F.lit(SLOTS - 1))


_SLOT = (f"least(greatest((CAST(ts AS DATE) - DATE '{FIRST_DAY}') // {DAYS}, 0) + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END, {SLOTS - 1})")


def replay(rows: DataFrame, base: str, start) -> None:
    """Lets the rows arrive slot by slot, and starts the job anew for each, from its checkpoint."""
    for k in range(SLOTS):
        rows.where(arrival_slot() == k).write.mode("ignore").parquet(f"{base}/arrivals/slot-{k}")
        ST.run(start(ST.stream_findings(rows.sparkSession, f"{base}/arrivals", rows.schema, files_per_trigger=None)))


def _findings(spark, d, name):
    base = ST.job_dir(spark, name, d)
    f = FD.findings(spark, d, load=ST.stream_table)
    return base, f.select("event_id", "finding", "url", "vuln_class", "severity", "batch_id", ST.event_time("ts").alias("event_ts"))


_F = S.with_(S.seed_urls_cte(), SF.FINDINGS)


@register("str1_stream_findings", _F + "SELECT event_id, finding, vuln_class FROM findings")
def q_str1(spark, d):
    """Files arrive in slots; the job is stopped after each and started again from its checkpoint."""
    base = ST.job_dir(spark, "str1-findings", d)
    rows = FD.findings(spark, d).select("event_id", "ts", "finding", "vuln_class")
    replay(rows, base, lambda s: ST.start_append(s.select("event_id", "finding", "vuln_class"), f"{base}/out", f"{base}/ckpt"))
    return spark.read.parquet(f"{base}/out")


@register("str2_stream_dedup", _F + "SELECT DISTINCT finding FROM findings")
def q_str2(spark, d):
    base, s = _findings(spark, d, "str2-dedup")
    ST.run(ST.start_distinct(s.select("finding"), "finding", f"{base}/out", f"{base}/ckpt"))
    return ST.read_batches(spark, f"{base}/out", "finding string").select("finding")


@register("str3_stream_route", _F + f"""
SELECT finding, arg_min(vuln_class, [{_SLOT}, event_id]) AS vuln_class FROM findings GROUP BY finding""")
def q_str3(spark, d):
    """Dedup + per-class folders in one sink: a repeated line goes to the class it first arrived
    with, by slot of arrival and then by event."""
    base = ST.job_dir(spark, "str3-route", d)
    rows = FD.findings(spark, d).select("event_id", "ts", "finding", "vuln_class")
    replay(rows, base, lambda s: ST.start_distinct(s.select("finding", "vuln_class", "event_id"), "finding", f"{base}/out", f"{base}/ckpt",
                                                   partition_by="vuln_class", order=["event_id"]))
    return ST.read_batches(spark, f"{base}/out", "finding string, event_id long, vuln_class string").select("finding", "vuln_class")


@register("str4_stream_alerts", _F + """
SELECT event_id, finding, severity AS alert_severity FROM findings WHERE severity IN ('medium', 'high', 'critical')""")
def q_str4(spark, d):
    base, s = _findings(spark, d, "str4-alerts")
    a = ST.stream_alerts(s).select("event_id", "finding", "alert_severity")
    ST.run(ST.start_append(a, f"{base}/out", f"{base}/ckpt"))
    return spark.read.parquet(f"{base}/out")


@register("str5_stream_totals", _F + "SELECT vuln_class, count(*) AS findings FROM findings GROUP BY vuln_class")
def q_str5(spark, d):
    base, s = _findings(spark, d, "str5-totals")
    ST.run(ST.start_batches(ST.stream_totals(s), f"{base}/out", f"{base}/ckpt"))
    return ST.latest_rows(spark, f"{base}/out", ["vuln_class"])


@register("str6_stream_js_corpus", S.with_(hits_cte()) + "SELECT * FROM dedup")
def q_str6(spark, d):
    base = ST.job_dir(spark, "str6-corpus", d)
    # texts take long to scan: a batch has as many files of a table as there are tasks at once
    load = partial(ST.stream_table, files_per_trigger=max(1, spark.sparkContext.defaultParallelism))
    s = T.secret_corpus(spark, d, load=load)
    rows = SE.findings(SE.scan_secrets(s))
    ST.run(ST.start_append(rows, f"{base}/out", f"{base}/ckpt"))
    # consolidation: one global dedup over everything the stream produced
    return SE.dedup_secrets(spark.read.parquet(f"{base}/out"))


@register("str7_windowed_findings", f"""
WITH arrived AS (SELECT event_type, ts, {_SLOT} AS slot FROM events),
latest AS (SELECT slot, max(max(ts)) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM arrived GROUP BY slot),
counted AS (
  SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, event_type,
    coalesce(date_trunc('hour', ts) + INTERVAL 1 HOUR <= before - INTERVAL {DELAY} SECOND, false) AS late
  FROM arrived JOIN latest USING (slot))
SELECT window_start, event_type, CAST(sum(CASE WHEN late THEN 0 ELSE 1 END) AS BIGINT) AS events,
  CAST(sum(CASE WHEN late THEN 1 ELSE 0 END) AS BIGINT) AS late_events
FROM counted GROUP BY 1, 2""")
def q_str7(spark, d):
    """All windows, with the rows that arrived in time and those that came too late."""
    base = ST.job_dir(spark, "str7-windows", d)
    rows = T.load(spark, d, "events").select("event_id", "ts", "event_type")
    replay(rows, base, lambda s: ST.start_windows(s, f"{base}/out", f"{base}/ckpt", delay=DELAY))
    return ST.windows_of(spark, f"{base}/out")
