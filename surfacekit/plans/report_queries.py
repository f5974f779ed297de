"""Registered queries over findings, phases, tool logs and the report roll-ups:
FLT13-FLT15, CLS4, PRJ13, PRJ14, JN2, JN13, AGG2-AGG9, WIN4, WIN6, WIN7, SNK4."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.functions.text import display_response, format_duration, line_first_token, line_last_token
from surfacekit.functions.urls import url_host
from surfacekit.operators import classify as C
from surfacekit.operators import endpoints as EP
from surfacekit.operators import filters as FL
from surfacekit.operators import inventory as INV
from surfacekit.operators import reporting as RP
from surfacekit.operators import secrets as SE
from surfacekit.operators import stat_store as ST
from surfacekit.operators.classify import tag_urls
from surfacekit.operators.links import page_links
from surfacekit.plans import sqlbits as S
from surfacekit.plans import sqlfind as SF
from surfacekit.plans import sqlinfra as SI
from surfacekit.plans import sqlobs as SO
from surfacekit.plans.infra_queries import _CT_NAMES, _HOST_SOURCES
from surfacekit.plans.registry import register
from surfacekit.plans.secret_queries import hits_cte
from surfacekit.sources import findings as FD
from surfacekit.sources import infra as I
from surfacekit.sources import observations as O
from surfacekit.sources import tables as T
from surfacekit.streaming.findings_stream import job_dir, work_dir

_F = S.with_(S.seed_urls_cte(), SF.FINDINGS)
_L = S.with_(S.seed_urls_cte(), SF.FINDINGS, SF.TOOL_LOGS)
_P = S.with_(SF.PHASES)


@register("flt13_severity_filter", _F + """
SELECT event_id, finding FROM findings WHERE severity IN ('medium', 'high', 'critical')""")
def q_flt13(spark, d):
    return FL.severity_filter(FD.findings(spark, d)).select("event_id", "finding")


@register("flt13_exclude_severities", _F + """
SELECT event_id, finding FROM findings WHERE severity NOT IN ('info', 'low')""")
def q_flt13_exclude(spark, d):
    return FL.severity_filter(FD.findings(spark, d), ("info", "low"), exclude=True).select("event_id", "finding")


@register("flt14_drop_log_noise", _L + """
SELECT stage, line FROM tool_logs WHERE trim(line) <> '' AND NOT contains(line, '[WRN]')
  AND NOT contains(line, '[INF]') AND NOT contains(line, 'invalid semicolon')""")
def q_flt14(spark, d):
    return FL.drop_log_noise(FD.tool_logs(spark, d))


@register("flt15_throttled", _L + """
SELECT stage, line FROM tool_logs WHERE contains(line, '429') OR contains(lower(line), 'rate limit')""")
def q_flt15(spark, d):
    return FL.throttled(FD.tool_logs(spark, d))


def _sev_sql(col: str) -> str:
    low = f"lower({col})"
    return (f"CASE WHEN regexp_extract({low}, '\\[(critical|high|medium|low|info)\\]', 1) <> '' "
            f"THEN regexp_extract({low}, '\\[(critical|high|medium|low|info)\\]', 1) "
            f"WHEN contains({low}, 'critical') THEN 'critical' WHEN contains({low}, 'high') THEN 'high' "
            f"WHEN contains({low}, 'medium') THEN 'medium' WHEN contains({low}, 'low') THEN 'low' ELSE 'other' END")


@register("cls4_finding_severity", _L + f"""
SELECT DISTINCT line, {_sev_sql('line')} AS severity FROM tool_logs""")
def q_cls4(spark, d):
    return FD.tool_logs(spark, d).select("line", C.severity_of("line").alias("severity")).distinct()


@register("prj13_format_duration", _P + f"""
SELECT phase, elapsed, {SF.fmt_duration('elapsed')} AS duration FROM phase_results""")
def q_prj13(spark, d):
    p = FD.phase_results(spark, d)
    return p.select("phase", "elapsed", format_duration("elapsed").alias("duration"))


@register("prj14_line_token", _L + f"""
SELECT DISTINCT line, {SF.first_token('line')} AS first_token, {SF.last_token('line')} AS last_token
FROM tool_logs WHERE trim(line) <> ''""")
def q_prj14(spark, d):
    t = FD.tool_logs(spark, d).where(F.trim("line") != "")
    return t.select("line", line_first_token("line").alias("first_token"),
                    line_last_token("line").alias("last_token")).distinct()


@register("jn2_new_only", _F + """
SELECT finding FROM findings WHERE ts >= TIMESTAMP '2024-01-16'
  AND finding NOT IN (SELECT finding FROM findings WHERE ts < TIMESTAMP '2024-01-16')""")
def q_jn2(spark, d):
    f = FD.findings(spark, d)
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return INV.new_only(f.where(F.col("ts") >= split).select("finding"),
                        f.where(F.col("ts") < split), "finding")


_TAGCLS = ", ".join(f"({S.lit(t)}, {S.lit(c)})" for t, c in RP.TAG_CLASS)


@register("jn13_tag_confirmation", S.with_(S.url_tags_cte(), SF.FINDINGS) + f""",
m(tag, vuln_class) AS (VALUES {_TAGCLS}),
tagged AS (SELECT DISTINCT t.url, t.tag, m.vuln_class FROM url_tags t JOIN m USING (tag)),
seen AS (SELECT DISTINCT url, vuln_class FROM findings)
SELECT tag, count(s.url) AS confirmed, CAST(sum(CASE WHEN s.url IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unconfirmed
FROM tagged t LEFT JOIN seen s USING (url, vuln_class) GROUP BY tag""")
def q_jn13(spark, d):
    return RP.tag_confirmation(tag_urls(T.url_corpus(spark, d)), FD.findings(spark, d))


@register("agg2_phase_summary", _P + """
SELECT count(*) AS phases, CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS ok,
  CAST(sum(CASE WHEN success THEN 0 ELSE 1 END) AS BIGINT) AS errored,
  CAST(sum(findings) AS BIGINT) AS findings, CAST(sum(elapsed) AS BIGINT) AS seconds FROM phase_results""")
def q_agg2(spark, d):
    return RP.phase_summary(FD.phase_results(spark, d))


@register("agg3_phase_anomalies", _P + """
SELECT phase, elapsed, reason, first_error FROM (
  SELECT phase, elapsed,
    CASE WHEN success AND findings = 0 AND elapsed < 2 THEN 'no-op' WHEN NOT success THEN 'errored' END AS reason,
    CASE WHEN NOT success THEN coalesce(list_filter(string_split(coalesce(error, ''), chr(10)),
      lambda l: trim(l) <> '' AND NOT contains(l, '[WRN]') AND NOT contains(l, '[INF]'))[1], '') END AS first_error
  FROM phase_results) WHERE reason IS NOT NULL""")
def q_agg3(spark, d):
    return RP.phase_anomalies(FD.phase_results(spark, d))


@register("agg4_class_counts", _F + """
SELECT vuln_class, count(*) AS findings FROM findings GROUP BY vuln_class
UNION ALL SELECT 'TOTAL', count(*) FROM findings""")
def q_agg4(spark, d):
    return RP.class_counts(FD.findings(spark, d))


# --------------------------------------------------------------------------- stats
TAG_METRIC = {"admin": "admin_panels", "sensitive": "sensitive_files", "high_impact": "high_impact_files", "xss": "xss_candidates",
              "sqli": "sqli_candidates", "ssrf": "ssrf_candidates", "redirect": "redirect_cands", "idor": "idor_candidates"}
CLASS_METRIC = {"cves": "cves", "misconfigurations": "misconfigs", "default_logins": "default_logins", "takeovers": "takeovers",
                "exposures": "exposures"}
STAT_TABLES = ("pages", "documents", "conversations", "events")


def stat_facts(spark, d: T.Part) -> DataFrame:
    """The facts of the 22 stats in the files that ``d`` shows. What a row is looked up in (the scope,
    the page a finding names) is the whole table's."""
    whole = str(d)
    p = T.pages(spark, d)
    # four facts use the links: the pages are read for them once
    links = page_links(p).select("url").distinct()
    path = work_dir(spark, "stats-links")
    links.write.parquet(path)
    links = spark.read.schema(links.schema).parquet(path)
    urls = p.select("url").unionByName(links).unionByName(T.seed_urls(spark, d).select("url")).distinct()
    js = FL.drop_vendor_js(FL.js_urls(urls)).select("url").unionByName(O.js_urls(spark, d).select("url"))
    of_url = F.concat(F.array(F.lit("total_urls")), F.filter(F.transform(C.tag_array("url"), lambda t: F.element_at(_literal_map(TAG_METRIC), t)), lambda m: m.isNotNull()))
    live = FL.live_responses(O.responses(spark, d)).select("url")
    api, graph = F.col("url").rlike(r"(?i)swagger|openapi|api-docs|redoc"), F.col("url").rlike(r"(?i)graphql|graphiql")
    hosts = (p.select(url_host("url").alias("host")).unionByName(links.select(url_host("url").alias("host")))
             .unionByName(_named_hosts(spark, d, I.scope_domains(spark, whole))).distinct())
    found = FD.findings(spark, d, pages=whole).select("vuln_class", F.col("finding").alias("key"))
    of_class = F.element_at(_literal_map(CLASS_METRIC), F.col("vuln_class"))
    secret = SE.keyed(SE.scan_secrets(T.secret_corpus(spark, d), windows=False))
    none = F.lit(None).cast(ST.RANK).alias("rank")
    parts = [
        urls.select(F.explode(of_url).alias("metric"), F.col("url").alias("key"), none),
        ST.fact(js, "js_files", "url"),
        ST.fact(live.select(url_host("url").alias("host")), "live_hosts", "host"),
        ST.fact(live, "live_endpoints", "url"),
        ST.fact(live.where(api), "api_docs"), ST.fact(live.where(graph), "graphql_endpoints"),
        ST.fact(FL.in_scope(hosts, "host", I.scope_domains(spark, whole)), "total_subdomains", "host"),
        ST.fact(I.ports(spark, d).select(F.concat_ws(" ", "host", "ip", "port").alias("port")), "open_ports", "port"),
        found.select(of_class.alias("metric"), "key", none).where("metric is not null"),
        secret.select(F.lit("secrets_found").alias("metric"), F.col("clean").alias("key"), F.struct("url", "rule_ord", "offset", "tier").cast(ST.RANK).alias("rank")),
    ]
    return reduce(DataFrame.unionByName, parts)


def _literal_map(values: dict[str, str]):
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _named_hosts(spark, d, scope) -> DataFrame:
    ct = INV.explode_ct_names(I.ct_entries(spark, d), scope).select("host")
    return ct.unionByName(INV.explode_sans(I.tls(spark, d)).select(F.col("san").alias("host")))


def stat_store(spark, d) -> ST.StatStore:
    """The store of the tables at ``d``, brought up to date: only files that it does not cover are
    scanned. A file that was replaced makes a new store."""
    ids = {name: ST.file_ids(spark, f"{d.rstrip('/')}/{name}.parquet") for name in STAT_TABLES}
    everything = {i for files in ids.values() for i in files.values()}
    generation = 0
    while (covered := (store := ST.StatStore(spark, f"{job_dir(spark, f'stats-{generation}', d)}")).covered()) - everything:
        generation += 1
    new = {name: [path for path, i in files.items() if i not in covered] for name, files in ids.items()}
    store.add([ids[name][path] for name, paths in new.items() for path in paths], lambda: stat_facts(spark, T.Part(d, new)))
    return store


def surface_stats(spark, d) -> DataFrame:
    return RP.surface_stats(ST.merged(stat_store(spark, d).partials()))


def _stats_sql() -> str:
    tag_metric = [("admin", "admin_panels"), ("sensitive", "sensitive_files"), ("high_impact", "high_impact_files"),
                  ("xss", "xss_candidates"), ("sqli", "sqli_candidates"), ("ssrf", "ssrf_candidates"),
                  ("redirect", "redirect_cands"), ("idor", "idor_candidates")]
    cls_metric = [("cves", "cves"), ("misconfigurations", "misconfigs"), ("default_logins", "default_logins"),
                  ("takeovers", "takeovers"), ("exposures", "exposures")]
    tm = " ".join(f"WHEN {S.lit(t)} THEN {S.lit(n)}" for t, n in tag_metric)
    cm = " ".join(f"WHEN {S.lit(t)} THEN {S.lit(n)}" for t, n in cls_metric)
    tags_in = ", ".join(S.lit(t) for t, _ in tag_metric)
    cls_in = ", ".join(S.lit(t) for t, _ in cls_metric)
    cols = ",\n  ".join(f"CAST(coalesce(max(CASE WHEN metric = {S.lit(n)} THEN value END), 0) AS BIGINT) AS {n}"
                        for n in RP.STAT_NAMES)
    return S.with_(S.url_tags_cte(), hits_cte(), SO.responses_cte(with_seed=False), SI.NETWORK, SI.CT,
                   _CT_NAMES, _HOST_SOURCES, SF.FINDINGS) + f""",
live AS (SELECT * FROM responses WHERE status IN (200, 201, 301, 302, 403)),
js AS (
  SELECT url FROM url_corpus WHERE regexp_matches(url, {S.ci(rules.JS_URL_PATTERN)})
    AND NOT regexp_matches(url, {S.ci(rules.VENDOR_JS_PATTERN)})
  UNION ALL SELECT {SO.js_url()} FROM pages
),
metrics AS (
  SELECT 'total_subdomains' AS metric, count(DISTINCT host) AS value FROM src_hosts WHERE {SI.in_scope('host')}
  UNION ALL SELECT 'live_hosts', count(DISTINCT {S.host('url')}) FROM live
  UNION ALL SELECT 'open_ports', count(*) FROM ports
  UNION ALL SELECT 'total_urls', count(*) FROM url_corpus
  UNION ALL SELECT 'live_endpoints', count(DISTINCT url) FROM live
  UNION ALL SELECT 'js_files', count(DISTINCT url) FROM js
  UNION ALL SELECT 'secrets_found', count(*) FROM dedup WHERE tier <= 2
  UNION ALL SELECT 'api_docs', count(*) FROM live WHERE regexp_matches(url, '(?i)swagger|openapi|api-docs|redoc')
  UNION ALL SELECT 'graphql_endpoints', count(*) FROM live WHERE regexp_matches(url, '(?i)graphql|graphiql')
  UNION ALL SELECT CASE tag {tm} END, count(*) FROM url_tags WHERE tag IN ({tags_in}) GROUP BY tag
  UNION ALL SELECT CASE vuln_class {cm} END, count(*) FROM (SELECT DISTINCT finding, vuln_class FROM findings)
    WHERE vuln_class IN ({cls_in}) GROUP BY vuln_class
),
stats AS (SELECT
  {cols}
  FROM metrics)"""


_STATS = _stats_sql()


@register("agg5_surface_stats", _STATS + "\nSELECT * FROM stats")
def q_agg5(spark, d):
    return surface_stats(spark, d)


@register("agg6_verdict", _STATS + """
SELECT critical, soft, leads, CASE WHEN critical > 0 THEN 'hot' WHEN soft >= 3 THEN 'worth'
  WHEN leads > 0 THEN 'quiet' ELSE 'hardened' END AS verdict FROM (
  SELECT cves + takeovers + default_logins + secrets_found AS critical,
    admin_panels + high_impact_files + misconfigs + api_docs + graphql_endpoints AS soft,
    xss_candidates + sqli_candidates + ssrf_candidates + idor_candidates + redirect_cands AS leads FROM stats)""")
def q_agg6(spark, d):
    return RP.verdict(surface_stats(spark, d))


@register("agg7_pipeline_health", _STATS + """
SELECT CASE WHEN live_hosts = 0 THEN 'no-live-hosts' WHEN total_urls = 0 THEN 'no-urls'
  WHEN js_files = 0 THEN 'no-js' ELSE 'healthy' END AS health FROM stats""")
def q_agg7(spark, d):
    return RP.pipeline_health(surface_stats(spark, d))


_SECT = "\n  UNION ALL ".join(f"SELECT {S.lit(s)} AS section, {i} AS ord, {S.lit(n)} AS name, {m} AS value FROM stats"
                              for i, (s, n, m) in enumerate(RP.SECTIONS))


@register("agg8_finding_sections", _STATS + f"""
SELECT * FROM (
  {_SECT}) WHERE value > 0""")
def q_agg8(spark, d):
    return RP.finding_sections(surface_stats(spark, d))


def _steps_sql() -> str:
    parts = []
    for prio, step, metrics in RP.NEXT_STEPS:
        cond = "TRUE" if not metrics else "(" + " + ".join(metrics) + ") > 0"
        parts.append(f"SELECT {prio} AS priority, {S.lit(step)} AS step FROM stats WHERE {cond}")
    return "\n  UNION ALL ".join(parts)


@register("agg9_next_steps", _STATS + f"""
SELECT priority, step, rank, rank <= 5 AS in_queue FROM (
  SELECT priority, step, row_number() OVER (ORDER BY priority) AS rank FROM (
  {_steps_sql()}))""")
def q_agg9(spark, d):
    return RP.next_steps(surface_stats(spark, d))


# --------------------------------------------------------------------------- WIN4
def _hv_lines(spark, d):
    urls = T.url_corpus(spark, d)
    live = FL.live_responses(O.responses(spark, d))
    routed = C.route_api_docs(live).select("url", "status", "is_api_doc", "is_graphql")
    rl = routed.join(live.select("url", "title"), "url").select(
        "is_api_doc", "is_graphql", display_response("url", "status", "title").alias("line"))
    cves = FD.findings(spark, d).where(F.col("vuln_class") == "cves").select(F.col("finding").alias("line"))
    return (FL.admin_panels(urls).select(F.lit("admin").alias("source"), F.col("url").alias("line"))
            .unionByName(rl.where("is_graphql").select(F.lit("graphql").alias("source"), "line"))
            .unionByName(rl.where("is_api_doc").select(F.lit("api_docs").alias("source"), "line"))
            .unionByName(cves.select(F.lit("cves").alias("source"), "line")))


@register("win4_high_value_targets", S.with_(S.url_sources_cte(), SO.responses_cte(with_seed=False), SF.FINDINGS) + f""",
live AS (SELECT * FROM responses WHERE status IN (200, 201, 301, 302, 403)),
rl AS (SELECT url || ' (' || CAST(status AS VARCHAR) || ') — ' || coalesce(title, '') AS line,
         regexp_matches(url, '(?i)swagger|openapi|api-docs|redoc') AS is_api_doc,
         regexp_matches(url, '(?i)graphql|graphiql') AS is_graphql FROM live),
lines AS (
  SELECT 'admin' AS source, url AS line FROM url_corpus WHERE regexp_matches(url, {S.ci(rules.ADMIN_PATTERN)})
  UNION ALL SELECT 'graphql', line FROM rl WHERE is_graphql
  UNION ALL SELECT 'api_docs', line FROM rl WHERE is_api_doc
  UNION ALL SELECT 'cves', finding FROM findings WHERE vuln_class = 'cves'
),
toks AS (SELECT source, CASE WHEN source = 'cves' THEN {SF.last_token('line')} ELSE {SF.first_token('line')} END AS target FROM lines)
SELECT target, array_to_string(list_sort(list_distinct(list(source))), ',') AS sources FROM toks
WHERE target IS NOT NULL AND target <> '' GROUP BY target ORDER BY target LIMIT 20""")
def q_win4(spark, d):
    return RP.high_value_targets(_hv_lines(spark, d), 20)


# a small number of chunks a task, so that the test tables split hosts as well
_WIN6 = {"size": 20, "chunks_per_task": 2}


@register("win6_assign_chunks", S.with_(S.url_sources_cte()) + f"""
SELECT url, host, salt, (row_number() OVER (PARTITION BY host, salt ORDER BY url) - 1) // {_WIN6['size']} AS chunk FROM (
  SELECT url, host, CAST(CAST(('0x' || substr(md5(url), 1, 7)) AS BIGINT) % parts AS INTEGER) AS salt FROM (
    SELECT url, host, CAST(ceil(count(*) OVER (PARTITION BY host) / {_WIN6['size'] * _WIN6['chunks_per_task']}.0) AS BIGINT) AS parts
    FROM url_corpus))""")
def q_win6(spark, d):
    return RP.assign_chunks(T.url_corpus(spark, d), **_WIN6).select("url", "host", "salt", "chunk")


def _batches(spark, d):
    f = FD.findings(spark, d)
    b = f.groupBy("phase", "batch_id").agg(F.sum(F.floor("value").cast("bigint")).alias("elapsed"))
    return b.join(b.groupBy("phase").agg(F.count("*").alias("total_batches")), "phase")


@register("win7_progress_eta", S.with_(S.seed_urls_cte(), SF.FINDINGS) + f""",
b AS (SELECT phase, batch_id, sum(CAST(floor(value) AS BIGINT)) AS elapsed FROM findings GROUP BY 1, 2),
bt AS (SELECT *, count(*) OVER (PARTITION BY phase) AS total_batches FROM b),
r AS (SELECT phase, batch_id, total_batches,
        count(*) OVER (PARTITION BY phase ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done,
        CAST(sum(elapsed) OVER (PARTITION BY phase ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS elapsed_so_far
      FROM bt)
SELECT phase, batch_id, done, elapsed_so_far, (elapsed_so_far * (total_batches - done)) // done AS eta_seconds,
  {SF.fmt_duration('((elapsed_so_far * (total_batches - done)) // done)')} AS eta,
  {SF.fmt_duration('elapsed_so_far')} AS elapsed_fmt FROM r""")
def q_win7(spark, d):
    return RP.progress_eta(_batches(spark, d))


@register("snk4_count_rows", S.with_(S.url_sources_cte(), SF.FINDINGS, SF.TOOL_LOGS) + """
SELECT 'tool_logs' AS table_name, count(*) AS n_rows FROM tool_logs WHERE trim(line) <> ''
UNION ALL SELECT 'urls', count(*) FROM url_corpus
UNION ALL SELECT 'findings', count(*) FROM findings""")
def q_snk4(spark, d):
    from surfacekit.sources.io import count_rows
    return (count_rows(FD.tool_logs(spark, d), "line").select(F.lit("tool_logs").alias("table_name"), "n_rows")
            .unionByName(count_rows(T.url_corpus(spark, d)).select(F.lit("urls").alias("table_name"), "n_rows"))
            .unionByName(count_rows(FD.findings(spark, d)).select(F.lit("findings").alias("table_name"), "n_rows")))
