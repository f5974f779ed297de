"""Registered queries over the URL corpus: EXT9, PRJ4, SET1, CLS1, FLT3-FLT11, AGG11."""

from __future__ import annotations

from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.functions import urls as U
from surfacekit.operators import filters as FL
from surfacekit.operators.aggregates import distinct_hosts_per_tag
from surfacekit.operators.classify import tag_urls
from surfacekit.operators import links as LK
from surfacekit.operators.links import page_links
from surfacekit.operators.responses import top_k_per_group
from surfacekit.plans import sqlbits as S
from surfacekit.plans.registry import register
from surfacekit.sources import tables as T

_URLS = S.url_sources_cte()


def url_tags(spark, d):
    return tag_urls(T.url_corpus(spark, d))


@register("agg11_tags_per_bucket", S.with_(S.url_tags_cte()) + """
SELECT tag, count(*) AS urls, count(DISTINCT host) AS hosts FROM url_tags GROUP BY tag""")
def q_agg11(spark, d):
    """Flagship: what URL risk classes does the corpus hold, on how many hosts?"""
    return distinct_hosts_per_tag(url_tags(spark, d))


@register("cls1_url_tags", S.with_(S.url_tags_cte()) + "SELECT url, tag FROM url_tags")
def q_cls1(spark, d):
    return url_tags(spark, d).select("url", "tag")


@register("ext9_page_links", S.with_(S.PAGE_LINKS) + "SELECT page_id, link, url FROM page_links")
def q_ext9(spark, d):
    return page_links(T.pages(spark, d)).select("page_id", "link", "url")


@register("set1_merge_distinct", S.with_(_URLS) + "SELECT DISTINCT url FROM url_sources")
def q_set1(spark, d):
    return T.url_sources(spark, d).select("url").distinct()


@register("src5_union_sources", S.with_(_URLS) + """
SELECT source, count(*) AS n_rows, count(DISTINCT url) AS n_urls FROM url_sources GROUP BY source""")
def q_src5(spark, d):
    return (T.url_sources(spark, d).groupBy("source")
            .agg(F.count("*").alias("n_rows"), F.countDistinct("url").alias("n_urls")))


@register("prj4_url_parts", S.with_(_URLS) + f"""
SELECT url, {S.scheme('url')} AS scheme, {S.host('url')} AS host, {S.port('url')} AS port,
       {S.path('url')} AS path, {S.query('url')} AS query, {S.fragment('url')} AS fragment
FROM (SELECT DISTINCT url FROM url_sources)""")
def q_prj4(spark, d):
    return U.url_parts(T.url_sources(spark, d).select("url").distinct())


def _flt_sql(pattern: str, negate: bool = False, base: str = "url_corpus") -> str:
    op = "NOT " if negate else ""
    return S.with_(_URLS) + f"SELECT url FROM {base} WHERE {op}regexp_matches(url, {S.ci(pattern)})"


@register("flt3_sensitive_files", _flt_sql(rules.SENSITIVE_EXTS))
def q_flt3(spark, d):
    return FL.sensitive_files(T.url_corpus(spark, d)).select("url")


@register("flt4_high_impact_files", _flt_sql(rules.HIGH_IMPACT_FILES))
def q_flt4(spark, d):
    return FL.high_impact_files(T.url_corpus(spark, d)).select("url")


@register("flt5_admin_panels", _flt_sql(rules.ADMIN_PATTERN))
def q_flt5(spark, d):
    return FL.admin_panels(T.url_corpus(spark, d)).select("url")


@register("flt6_api_endpoints", _flt_sql(rules.API_PATTERN))
def q_flt6(spark, d):
    return FL.api_endpoints(T.url_corpus(spark, d)).select("url")


@register("flt7_api_routes", S.with_(_URLS) + f"""
SELECT DISTINCT trim(url) AS url FROM url_sources
WHERE trim(url) <> '' AND regexp_matches(trim(url), {S.ci(rules.API_ROUTE_PATTERN)})""")
def q_flt7(spark, d):
    return FL.api_routes(T.url_sources(spark, d))


@register("flt8_keyword_urls", S.with_(_URLS) + f"""
SELECT url, array_to_string(list_sort(list_distinct(
         regexp_extract_all(lower(url), {S.lit(rules.KEYWORD_PATTERN)}, 1))), ',') AS keywords
FROM url_corpus WHERE regexp_matches(url, {S.ci(rules.KEYWORD_PATTERN)})""")
def q_flt8(spark, d):
    return FL.keyword_urls(T.url_corpus(spark, d)).select("url", "keywords")


@register("flt9_js_urls", _flt_sql(rules.JS_URL_PATTERN))
def q_flt9(spark, d):
    return FL.js_urls(T.url_corpus(spark, d)).select("url")


@register("flt10_drop_vendor_js", S.with_(_URLS) + f"""
SELECT url FROM url_corpus WHERE regexp_matches(url, {S.ci(rules.JS_URL_PATTERN)})
  AND NOT regexp_matches(url, {S.ci(rules.VENDOR_JS_PATTERN)})""")
def q_flt10(spark, d):
    return FL.drop_vendor_js(FL.js_urls(T.url_corpus(spark, d))).select("url")


@register("flt11_drop_static_assets", _flt_sql(rules.STATIC_ASSET_PATTERN, negate=True))
def q_flt11(spark, d):
    return FL.drop_static_assets(T.url_corpus(spark, d)).select("url")


_ROBOTS = f"""
rp AS (SELECT {S.host('url')} AS host, {S.scheme('url')} || '://' || {S.authority('url')} AS base,
              {S.path('url')} AS path, html FROM pages),
robots_docs AS (
  SELECT host, 'robots' AS kind, concat_ws(chr(10), 'User-agent: *', 'Disallow: ' || path, 'Allow: /',
         '# comment line', 'Sitemap: ' || base || '/sitemap.xml') AS text FROM rp
  UNION ALL
  SELECT host, 'sitemap', array_to_string(list_concat(['<urlset>'], list_transform(
         regexp_extract_all(html, 'href="(/[^"]*)"', 1), lambda x: '<url><loc>' || base || x || '</loc></url>')), chr(10))
  FROM rp
),
doc_lines AS (
  SELECT host, kind, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM robots_docs
)"""


@register("ext10_robots_paths", S.with_(_ROBOTS) + f"""
SELECT host, directive, value FROM (
  SELECT host, lower(regexp_extract(line, {S.lit(LK.ROBOTS_DIRECTIVE)}, 1)) AS directive,
         regexp_extract(line, {S.lit(LK.ROBOTS_DIRECTIVE)}, 2) AS value FROM doc_lines WHERE kind = 'robots')
WHERE directive <> ''
UNION ALL
SELECT host, 'loc', unnest(regexp_extract_all(line, {S.lit(LK.SITEMAP_LOC)}, 1)) FROM doc_lines
WHERE kind = 'sitemap'""")
def q_ext10(spark, d):
    return LK.robots_paths(T.robots_docs(spark, d))


@register("ext10_humans_fields", f"""
WITH h AS (SELECT page_id, {S.host('url')} AS host, {S.scheme('url')} || '://' || {S.host('url')} AS base FROM pages)
SELECT host, CASE WHEN page_id % 3 > 0 THEN 'TEAM' ELSE '' END AS section, 'editor' AS field, 'person ' || page_id AS value FROM h
UNION ALL SELECT host, CASE WHEN page_id % 3 > 0 THEN 'TEAM' ELSE '' END, 'contact', 'desk@' || host FROM h
UNION ALL SELECT host, 'SITE', 'address', base FROM h
UNION ALL SELECT host, '', 'readers', CAST(page_id AS VARCHAR) FROM h WHERE page_id % 5 = 0""")
def q_ext10_humans(spark, d):
    return LK.humans_fields(T.humans_docs(spark, d))


# A caller's own classes, beside the library's.
_OWN_TAGS = (rules.UrlRule("paged", r"[?&]page=[0-9]+"), rules.UrlRule("deep_path", r"^[a-z]+://[^/?#]*(/[^/?#]+){3}"))


@register("cls1_user_tags", S.with_(_URLS) + "\nUNION ALL\n".join(
    f"SELECT url, host, {S.lit(r.tag)} AS tag FROM url_corpus WHERE regexp_matches(url, {S.ci(r.pattern)})"
    for r in rules.ALL_URL_RULES + _OWN_TAGS))
def q_cls1_user(spark, d):
    """CLS1 with rules of the caller's own after the library's."""
    return tag_urls(T.url_corpus(spark, d).select("url", "host"), rules.ALL_URL_RULES + _OWN_TAGS)


@register("win5_urls_per_host", S.with_(_URLS) + """
SELECT url, host FROM (SELECT url, host, row_number() OVER (PARTITION BY host ORDER BY url) AS n
  FROM (SELECT DISTINCT url, host FROM url_corpus)) WHERE n <= 20 ORDER BY url LIMIT 50000""")
def q_win5_hosts(spark, d):
    """WIN5, Q16: the first 50,000 URLs, 20 of a host at most."""
    urls = T.url_corpus(spark, d).select("url", "host").distinct()
    return top_k_per_group(urls, "host", [F.asc("url")], 50_000, 20)


@register("srt1_sorted_distinct", S.with_(_URLS) + "SELECT DISTINCT host FROM url_corpus ORDER BY host")
def q_srt1(spark, d):
    """SRT1: distinct, sorted only at the output (range-partitioned sort)."""
    return T.url_corpus(spark, d).select("host").distinct().orderBy("host")
