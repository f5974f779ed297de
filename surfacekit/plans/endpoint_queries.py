"""Registered queries: EXT6, EXT7, SET3, WIN2, EXT8, PRJ7, ARR4, JN7, AGG10."""

from __future__ import annotations

from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.functions.urls import source_map_url
from surfacekit.operators import endpoints as EP
from surfacekit.operators import filters as FL
from surfacekit.operators import secrets as SE
from surfacekit.operators.links import page_links
from surfacekit.plans import sqlbits as S
from surfacekit.plans import sqlobs as SO
from surfacekit.plans.registry import register
from surfacekit.plans.secret_queries import corpus_cte, hits_cte
from surfacekit.sources import observations as O
from surfacekit.sources import tables as T


def _eps_sql() -> str:
    parts = "\n    UNION ALL ".join(
        f"SELECT unnest(regexp_extract_all(content, {S.lit(p)}, 1)) AS ep FROM js_corpus"
        for p in rules.ENDPOINT_PATTERNS)
    return f"""
eps_raw AS (
    {parts}
),
endpoints AS (
  SELECT DISTINCT endpoint FROM (
    SELECT regexp_replace(ep, '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g') AS endpoint FROM eps_raw)
  WHERE length(endpoint) >= 3
    AND NOT regexp_matches(endpoint, {S.ci(rules.ENDPOINT_STATIC)})
)"""


def cluster_sql(col: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({col}, {S.lit(p)}) THEN {S.lit(n)}"
                     for n, p in rules.ENDPOINT_CLUSTERS)
    return f"CASE {whens} ELSE 'other' END"


_EPW = S.with_(corpus_cte(), _eps_sql())


def _endpoints(spark, d):
    return EP.extract_endpoints(T.js_corpus(spark, d))


@register("ext6_extract_endpoints", _EPW + "SELECT endpoint FROM endpoints")
def q_ext6(spark, d):
    return _endpoints(spark, d)


@register("ext7_cluster_endpoints", _EPW + f"SELECT endpoint, {cluster_sql('endpoint')} AS cluster FROM endpoints")
def q_ext7(spark, d):
    return EP.cluster_endpoints(_endpoints(spark, d))


_OWN_CLUSTERS = (("search", r"(?i)/search([/?#.]|$)"), ("metrics", r"(?i)/metrics$"))


@register("ext7_endpoint_files", S.with_(corpus_cte()) + ",\nper_file AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT url, unnest(regexp_extract_all(content, {S.lit(p)}, 1)) AS ep FROM js_corpus" for p in rules.ENDPOINT_PATTERNS) + f"""
), eps AS (
  SELECT DISTINCT url, regexp_replace(ep, '^[ \\t\\n\\f\\r]+|[ \\t\\n\\f\\r]+$', '', 'g') AS endpoint FROM per_file)
SELECT url, endpoint, CASE {" ".join(f"WHEN regexp_matches(endpoint, {S.lit(p)}) THEN {S.lit(n)}" for n, p in _OWN_CLUSTERS)}
  ELSE {cluster_sql('endpoint')} END AS cluster
FROM eps WHERE length(endpoint) >= 3 AND NOT regexp_matches(endpoint, {S.ci(rules.ENDPOINT_STATIC)})""")
def q_ext7_files(spark, d):
    """endpoints(url, endpoint, cluster): which file holds it, with rules of the caller's own first."""
    eps = EP.extract_endpoints(T.js_corpus(spark, d), keep=("url",))
    return EP.cluster_endpoints(eps, extra=_OWN_CLUSTERS)


_SET3 = S.with_(corpus_cte(), _eps_sql(), S.PAGE_LINKS) + f"""
, merged AS (
  SELECT endpoint FROM endpoints
  UNION SELECT trim(link) FROM page_links WHERE starts_with(trim(link), '/') AND length(trim(link)) > 2
)
SELECT endpoint, {cluster_sql('endpoint')} AS cluster FROM merged"""


@register("set3_merge_endpoints", _SET3)
def q_set3(spark, d):
    links = page_links(T.pages(spark, d)).select(F.col("link").alias("line"))
    return EP.merge_endpoints(_endpoints(spark, d), links)


_HV = ", ".join(S.lit(c) for c in rules.HIGH_VALUE_CLUSTERS)


@register("win2_endpoint_examples", _EPW + f"""
SELECT cluster, endpoint, rank FROM (
  SELECT endpoint, cluster, row_number() OVER (PARTITION BY cluster ORDER BY endpoint) AS rank
  FROM (SELECT endpoint, {cluster_sql('endpoint')} AS cluster FROM endpoints)
  WHERE cluster IN ({_HV})) WHERE rank <= 10""")
def q_win2(spark, d):
    return EP.endpoint_examples(EP.cluster_endpoints(_endpoints(spark, d))).select(
        "cluster", "endpoint", "rank")


def _cloud_sql() -> str:
    hosts = "\n  UNION ALL ".join(
        f"SELECT {S.lit(n)} AS provider, unnest(regexp_extract_all(lower(text), {S.lit(p)})) AS ref FROM texts"
        for n, p in EP.CLOUD_HOST_PATTERNS)
    return f"""
texts AS (SELECT url AS text FROM url_corpus UNION ALL SELECT content FROM js_corpus),
refs AS (
  SELECT 's3' AS provider, unnest(regexp_extract_all(text, {S.lit(rules.S3_REFERENCE)})) AS ref FROM texts
  UNION ALL {hosts}
)"""


@register("ext8_cloud_references", S.with_(S.url_sources_cte(), corpus_cte(), _cloud_sql())
          + "SELECT DISTINCT provider, ref FROM refs")
def q_ext8(spark, d):
    texts = (T.url_corpus(spark, d).select(F.col("url").alias("text"))
             .unionByName(T.js_corpus(spark, d).select(F.col("content").alias("text"))))
    return EP.cloud_references(texts)


_JSU = S.with_(S.url_sources_cte()) + f""",
js AS (
  SELECT url FROM url_corpus WHERE regexp_matches(url, {S.ci(rules.JS_URL_PATTERN)})
  UNION SELECT {SO.js_url()} FROM pages
)"""


@register("prj7_source_map_url", _JSU + f"\nSELECT url AS js_url, {SO.map_url('url')} AS map_url FROM js")
def q_prj7(spark, d):
    return _all_js(spark, d).select(F.col("url").alias("js_url"), source_map_url("url").alias("map_url"))


def _all_js(spark, d):
    return (FL.js_urls(T.url_corpus(spark, d)).select("url")
            .unionByName(O.js_urls(spark, d).select("url")).distinct())


@register("arr4_explode_source_map", S.with_(SO.source_maps_cte()) + f"""
SELECT map_url, pos, source, rank FROM (
  SELECT map_url, pos, source, row_number() OVER (PARTITION BY map_url ORDER BY pos) AS rank FROM (
    SELECT map_url, unnest(range(len(sources))) AS pos, unnest(sources) AS source FROM source_maps)
  WHERE regexp_matches(source, {S.lit(EP.INTERESTING_SOURCE)}))""")
def q_arr4(spark, d):
    return EP.explode_source_map(O.source_maps(spark, d)).select("map_url", "pos", "source", "rank")


@register("jn7_exposed_source_maps", _JSU + "," + SO.responses_cte(with_seed=False) + f"""
SELECT js.url AS js_url, {SO.map_url('js.url')} AS map_url FROM js
JOIN responses r ON r.url = {SO.map_url('js.url')} AND r.status = 200""")
def q_jn7(spark, d):
    return EP.exposed_source_maps(_all_js(spark, d), O.responses(spark, d)).select("js_url", "map_url")


@register("agg10_secret_summary", S.with_(hits_cte(), _eps_sql()) + f"""
SELECT 'tier' AS section, CAST(tier AS VARCHAR) AS name, count(*) AS value FROM dedup GROUP BY tier
UNION ALL SELECT 'files', 'with_findings', count(DISTINCT url) FROM dedup
UNION ALL SELECT 'endpoints', cluster, count(*) FROM (
  SELECT {cluster_sql('endpoint')} AS cluster FROM endpoints) GROUP BY cluster""")
def q_agg10(spark, d):
    f = SE.secret_findings(T.secret_corpus(spark, d))
    return SE.secret_summary(f, EP.cluster_endpoints(_endpoints(spark, d)))
