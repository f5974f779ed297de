"""Registered queries over recorded responses: FLT12, CLS2, CLS3, CLS6, ARR5, AGG1, WIN1,
WIN5, JN1, JN4, PRJ12."""

from __future__ import annotations

from pyspark.sql import functions as F

from surfacekit.functions.text import display_response
from surfacekit.operators import classify as C
from surfacekit.operators import filters as FL
from surfacekit.operators import responses as R
from surfacekit.plans import sqlbits as S
from surfacekit.plans import sqlobs as SO
from surfacekit.plans.registry import register
from surfacekit.sources import observations as O

_R = S.with_(SO.responses_cte())


def _resp(spark, d):
    return O.responses(spark, d)


@register("flt12_live_responses", _R + """
SELECT url, status FROM responses WHERE status IN (200, 201, 301, 302, 403)""")
def q_flt12(spark, d):
    return FL.live_responses(_resp(spark, d)).select("url", "status")


@register("flt12_sweep_responses", _R + f"""
SELECT url, status FROM responses WHERE status IN {FL.SWEEP_STATUS}""")
def q_flt12_sweep(spark, d):
    return FL.live_responses(_resp(spark, d), FL.SWEEP_STATUS).select("url", "status")


@register("flt12_version_responses", _R + f"""
SELECT url, status FROM responses WHERE status IN {FL.VERSION_PROBE_STATUS}""")
def q_flt12_versions(spark, d):
    return FL.live_responses(_resp(spark, d), FL.VERSION_PROBE_STATUS).select("url", "status")


@register("cls2_route_api_docs", _R + """
SELECT url, regexp_matches(url, '(?i)swagger|openapi|api-docs|redoc') AS is_api_doc,
       regexp_matches(url, '(?i)graphql|graphiql') AS is_graphql
FROM responses WHERE status IN (200, 201, 301, 302, 403)
  AND (regexp_matches(url, '(?i)swagger|openapi|api-docs|redoc') OR regexp_matches(url, '(?i)graphql|graphiql'))""")
def q_cls2(spark, d):
    live = FL.live_responses(_resp(spark, d))
    return C.route_api_docs(live).select("url", "is_api_doc", "is_graphql")


@register("cls3_introspection_enabled", _R + """
SELECT url, status FROM responses WHERE contains(body, '__schema')""")
def q_cls3(spark, d):
    return C.introspection_enabled(_resp(spark, d)).select("url", "status")


@register("cls6_cdn_provider", _R + "," + SO.headers_cte() + """
SELECT host, line, cdn, host || ': ' || trim(line) AS tagged FROM (
  SELECT host, line, regexp_extract(lower(line), '(x-amz|cloudfront|cloudflare|fastly|akamai|cdn)', 1) AS cdn
  FROM response_headers) WHERE cdn <> ''""")
def q_cls6(spark, d):
    return C.cdn_provider(O.response_headers(spark, d))


@register("arr5_explode_tech", _R + "SELECT url, unnest(tech) AS tech FROM responses")
def q_arr5(spark, d):
    return R.explode_tech(_resp(spark, d))


@register("agg1_tech_summary", _R + """
SELECT tech, count(*) AS responses FROM (SELECT unnest(tech) AS tech FROM responses) GROUP BY tech""")
def q_agg1(spark, d):
    return R.tech_summary(_resp(spark, d))


@register("win5_top_technologies", _R + """
SELECT tech, count(*) AS responses FROM (SELECT unnest(tech) AS tech FROM responses)
GROUP BY tech ORDER BY responses DESC, tech LIMIT 15""")
def q_win5(spark, d):
    return R.top_technologies(_resp(spark, d), 15)


@register("win1_tech_examples", _R + """
SELECT tech, url, rank FROM (
  SELECT tech, url, row_number() OVER (PARTITION BY tech ORDER BY url) AS rank
  FROM (SELECT url, unnest(tech) AS tech FROM responses)) WHERE rank <= 20""")
def q_win1(spark, d):
    return R.tech_examples(_resp(spark, d), 20).select("tech", "url", "rank")


def _hints_values() -> str:
    return ", ".join(f"({S.lit(k)}, {i}, {S.lit(h)})" for i, (k, h) in enumerate(R.TECH_HINTS))


@register("jn1_tech_hints", _R + f""",
hints(tech_key, hint_ord, hint) AS (VALUES {_hints_values()}),
techs AS (SELECT DISTINCT lower(unnest(tech)) AS t FROM responses),
matched AS (
  SELECT DISTINCT tech_key, hint_ord, hint FROM hints
  WHERE EXISTS (SELECT 1 FROM techs WHERE strpos(t, tech_key) > 0)
)
SELECT * FROM matched
UNION ALL SELECT 'none', -1, {S.lit(R.NO_HINT)} WHERE NOT EXISTS (SELECT 1 FROM matched)""")
def q_jn1(spark, d):
    return R.tech_hints(_resp(spark, d))


def _expected_sql(paths) -> str:
    return _R + f""",
bases AS (
  SELECT DISTINCT {S.scheme('url')} || '://' || lower({S.authority('url')}) AS base FROM responses
  WHERE status IN (200, 201, 301, 302, 403)
),
cand AS (SELECT base, unnest([{", ".join(S.lit(p) for p in paths)}]) AS path FROM bases),
seen AS (SELECT url, min(status) AS status FROM responses GROUP BY url)
SELECT c.base, c.path, c.base || c.path AS url, r.status IS NOT NULL AS seen, r.status
FROM cand c LEFT JOIN seen r ON r.url = c.base || c.path"""


@register("jn4_expected_paths", _expected_sql(R.API_DOC_PATHS))
def q_jn4(spark, d):
    resp = _resp(spark, d)
    return R.expected_paths(FL.live_responses(resp), resp)


@register("jn4_version_paths", _expected_sql(R.API_VERSION_PATHS))
def q_jn4_versions(spark, d):
    resp = _resp(spark, d)
    return R.expected_paths(FL.live_responses(resp), resp, R.API_VERSION_PATHS)


@register("prj12_display_response", _R + """
SELECT url, url || ' (' || CAST(status AS VARCHAR) || ') — ' || coalesce(title, '') AS line
FROM responses WHERE status IN (200, 201, 301, 302, 403)""")
def q_prj12(spark, d):
    live = FL.live_responses(_resp(spark, d))
    return live.select("url", display_response("url", "status", "title").alias("line"))
