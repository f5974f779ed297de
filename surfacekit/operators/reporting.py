"""Findings, phases and report roll-ups: AGG2-AGG9, WIN4, WIN6, WIN7, JN13.

The stats record is one wide row of BIGINT counts whose names are load-bearing. It is
built as a long (metric, value) union of scalar aggregates -- each a partial+final hash
aggregate -- and pivoted to one row with ``max(when)``; everything after it works on
that single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfacekit.functions.text import format_duration, line_first_token, line_last_token

# FIXED VALUES: the 22 stats names, in report order.
STAT_NAMES = ("total_subdomains", "live_hosts", "open_ports", "total_urls", "live_endpoints",
              "js_files", "secrets_found", "api_docs", "graphql_endpoints", "admin_panels",
              "sensitive_files", "high_impact_files", "xss_candidates", "sqli_candidates",
              "ssrf_candidates", "redirect_cands", "idor_candidates", "cves", "misconfigs",
              "default_logins", "takeovers", "exposures")


def phase_summary(phases: DataFrame) -> DataFrame:
    """AGG2: phases run / ok / errored, total findings, total seconds."""
    return phases.agg(F.count("*").alias("phases"),
                      F.sum(F.col("success").cast("int")).cast("bigint").alias("ok"),
                      F.sum((~F.col("success")).cast("int")).cast("bigint").alias("errored"),
                      F.sum("findings").cast("bigint").alias("findings"),
                      F.sum("elapsed").cast("bigint").alias("seconds"))


NOISE_MARKERS = ("[WRN]", "[INF]")


def phase_anomalies(phases: DataFrame) -> DataFrame:
    """AGG3: 'did not really run' (success, 0 findings, < 2 s) and errored phases with their
    first meaningful error line (noise lines skipped)."""
    lines = F.split(F.coalesce("error", F.lit("")), "\n")
    meaningful = F.filter(lines, lambda l: (F.trim(l) != "") & ~l.contains("[WRN]") & ~l.contains("[INF]"))
    first = F.coalesce(F.try_element_at(meaningful, F.lit(1)), F.lit(""))
    reason = (F.when(F.col("success") & (F.col("findings") == 0) & (F.col("elapsed") < 2),
                     F.lit("no-op"))
              .when(~F.col("success"), F.lit("errored")))
    return (phases.select("phase", "elapsed", reason.alias("reason"),
                          F.when(~F.col("success"), first).alias("first_error"))
            .where(F.col("reason").isNotNull()))


def class_counts(findings: DataFrame) -> DataFrame:
    """AGG4: findings per class (non-zero only) plus the grand total (class 'TOTAL')."""
    r = findings.rollup("vuln_class").agg(F.count("*").alias("findings"))
    return r.select(F.coalesce("vuln_class", F.lit("TOTAL")).alias("vuln_class"), "findings")


def surface_stats(metrics: DataFrame) -> DataFrame:
    """AGG5: long (metric, value) -> one wide row with the 22 names (0 when missing)."""
    return metrics.agg(*[F.coalesce(F.max(F.when(F.col("metric") == n, F.col("value"))),
                                    F.lit(0)).cast("bigint").alias(n) for n in STAT_NAMES])


def verdict(stats: DataFrame) -> DataFrame:
    """AGG6: critical / soft / leads sums and the ordered verdict."""
    c = F.col
    critical = c("cves") + c("takeovers") + c("default_logins") + c("secrets_found")
    soft = c("admin_panels") + c("high_impact_files") + c("misconfigs") + c("api_docs") + c("graphql_endpoints")
    leads = (c("xss_candidates") + c("sqli_candidates") + c("ssrf_candidates") + c("idor_candidates")
             + c("redirect_cands"))
    v = (F.when(critical > 0, F.lit("hot")).when(soft >= 3, F.lit("worth"))
         .when(leads > 0, F.lit("quiet")).otherwise(F.lit("hardened")))
    return stats.select(critical.alias("critical"), soft.alias("soft"), leads.alias("leads"), v.alias("verdict"))


def pipeline_health(stats: DataFrame) -> DataFrame:
    """AGG7: first upstream gap (no hosts / hosts but no URLs / URLs but no scripts),
    'healthy' when none."""
    c = F.col
    note = (F.when(c("live_hosts") == 0, F.lit("no-live-hosts"))
            .when(c("total_urls") == 0, F.lit("no-urls"))
            .when(c("js_files") == 0, F.lit("no-js"))
            .otherwise(F.lit("healthy")))
    return stats.select(note.alias("health"))


# FIXED VALUES: report sections (section, display name, stat), in order.
SECTIONS = (
    ("confirmed", "CVEs", "cves"), ("confirmed", "Subdomain Takeovers", "takeovers"),
    ("confirmed", "Default Logins", "default_logins"), ("confirmed", "Exposed Secrets", "secrets_found"),
    ("exposure", "High-Impact Files", "high_impact_files"), ("exposure", "Misconfigurations", "misconfigs"),
    ("exposure", "Exposures", "exposures"), ("exposure", "Admin Panels", "admin_panels"),
    ("vector", "XSS", "xss_candidates"), ("vector", "SQLi", "sqli_candidates"),
    ("vector", "SSRF", "ssrf_candidates"), ("vector", "Open Redirect", "redirect_cands"),
    ("vector", "IDOR", "idor_candidates"),
)


def finding_sections(stats: DataFrame) -> DataFrame:
    """AGG8: unpivot (stack) the stats into (section, ord, name, value), count > 0 only."""
    args = ", ".join(f"'{s}', {i}, '{n}', {m}" for i, (s, n, m) in enumerate(SECTIONS))
    return (stats.selectExpr(f"stack({len(SECTIONS)}, {args}) AS (section, ord, name, value)")
            .where(F.col("value") > 0))


# Next steps: (priority, step, condition over stats); wording is ours.
NEXT_STEPS = (
    (1, "verify and rotate exposed secrets", ("secrets_found",)),
    (2, "disable default logins", ("default_logins",)),
    (3, "remove dangling DNS records (takeovers)", ("takeovers",)),
    (4, "patch matched CVEs", ("cves",)),
    (5, "restrict admin panels", ("admin_panels",)),
    (6, "review published API surface", ("api_docs", "graphql_endpoints")),
    (7, "review parameterised URL candidates", ("xss_candidates", "sqli_candidates", "ssrf_candidates",
                                                "idor_candidates", "redirect_cands")),
    (8, "complete the manual OSINT checklist", ()),
    (9, "check code-search results for source leaks", ()),
    (10, "verify cloud storage hits", ()),
)


def next_steps(stats: DataFrame, queue: int = 5) -> DataFrame:
    """AGG9: priority-ordered actions whose condition holds (standing items always), the
    first ``queue`` of them flagged as the queue. Works on the one-row stats frame."""
    rows = []
    for prio, step, metrics in NEXT_STEPS:
        cond = F.lit(True) if not metrics else (sum((F.col(m) for m in metrics[1:]), F.col(metrics[0])) > 0)
        rows.append(F.when(cond, F.struct(F.lit(prio).alias("priority"), F.lit(step).alias("step"))))
    s = stats.select(F.posexplode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("pos", "s"))
    # rank = position among the applicable steps (already in priority order): no window
    return s.select("s.priority", "s.step", (F.col("pos") + 1).alias("rank"),
                    (F.col("pos") < queue).alias("in_queue"))


def high_value_targets(lines: DataFrame, k: int = 20) -> DataFrame:
    """WIN4: first token of admin / GraphQL / API-doc lines, last token of CVE lines
    (only with '[' and >= 3 tokens); distinct targets with their sources; first k sorted."""
    tok = F.when(F.col("source") == "cves", line_last_token("line")).otherwise(line_first_token("line"))
    t = lines.select("source", tok.alias("target")).where(F.col("target").isNotNull() & (F.col("target") != ""))
    g = t.groupBy("target").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    return g.orderBy("target").limit(k)


def assign_chunks(urls: DataFrame, size: int = 400, chunks_per_task: int = 64,
                  key: str = "host", col: str = "url") -> DataFrame:
    """WIN6: contiguous chunks of at most ``size`` URLs per key. A key of more than ``size`` x
    ``chunks_per_task`` URLs is split into as many sub-groups as it needs, by a hash of the URL,
    so one that holds a third of all URLs is numbered by many tasks; smaller keys stay whole."""
    n = urls.groupBy(key).agg(F.ceil(F.count("*") / (size * chunks_per_task)).alias("parts"))
    salt = F.pmod(F.conv(F.substring(F.md5(F.col(col)), 1, 7), 16, 10).cast("bigint"), F.col("parts")).cast("int")
    u = urls.join(n, key).withColumn("salt", salt).drop("parts")
    w = Window.partitionBy(key, "salt").orderBy(col)
    return (u.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / size).cast("bigint"))
            .withColumn("chunk_id", F.concat_ws("/", F.col(key), F.col("salt").cast("string"),
                                                F.col("chunk").cast("string"))))


def progress_eta(batches: DataFrame, total_col: str = "total_batches", block: int = 1000) -> DataFrame:
    """WIN7: per phase, running elapsed seconds and batches done in batch order; rate =
    elapsed / done; remaining = rate x batches left (exact integer arithmetic); formatted
    durations. Running sums within blocks of batch ids plus the sums of the earlier blocks, so
    a phase is spread over as many tasks as it has blocks."""
    b = batches.withColumn("block", F.floor(F.col("batch_id") / block))
    sums = b.groupBy("phase", "block").agg(F.count("*").alias("n"), F.sum("elapsed").alias("s"))
    earlier = Window.partitionBy("phase").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("phase", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
                       F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s0"))
    w = Window.partitionBy("phase", "block").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    b = (b.join(base, ["phase", "block"]).withColumn("done", F.count("*").over(w) + F.col("n0"))
         .withColumn("elapsed_so_far", (F.sum("elapsed").over(w) + F.col("s0")).cast("bigint")))
    remaining = F.expr(f"(elapsed_so_far * ({total_col} - done)) div done")
    return b.select("phase", "batch_id", "done", "elapsed_so_far",
                    remaining.alias("eta_seconds"), format_duration(remaining).alias("eta"),
                    format_duration(F.col("elapsed_so_far")).alias("elapsed_fmt"))


# FIXED VALUES: URL bucket -> finding class confirmed for it.
TAG_CLASS = (
    ("redirect", "open_redirects"), ("xss", "xss_vulnerabilities"), ("sqli", "sqli_vulnerabilities"),
    ("ssrf", "ssrf_vulnerabilities"), ("idor", "idor_vulnerabilities"), ("ssti", "ssti_vulnerabilities"),
    ("lfi", "lfi_param_vulns"), ("cors", "cors_param_vulns"), ("rce", "rce_param_vulns"),
    ("debug", "debug_param_vulns"),
)


def tag_confirmation(url_tags: DataFrame, findings: DataFrame) -> DataFrame:
    """JN13: tagged URLs of mapped buckets (broadcast of the 10-row map), left join the
    recorded findings on (url, class); per tag, confirmed and unconfirmed URLs."""
    spark = url_tags.sparkSession
    m = F.broadcast(spark.createDataFrame(list(TAG_CLASS), "tag string, vuln_class string"))
    tagged = url_tags.select("url", "tag").distinct().join(m, "tag")
    seen = findings.select("url", "vuln_class").distinct().withColumn("hit", F.lit(1))
    j = tagged.join(seen, ["url", "vuln_class"], "left")
    return j.groupBy("tag").agg(F.count("hit").alias("confirmed"),
                                F.sum(F.when(F.col("hit").isNull(), 1).otherwise(0)).cast("bigint")
                                .alias("unconfirmed"))
