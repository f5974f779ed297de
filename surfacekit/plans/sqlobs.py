"""DuckDB CTEs for the derived observation tables (see sources/observations.py)."""

from __future__ import annotations

from surfacekit.plans import sqlbits as S
from surfacekit.sources import observations as O


def pick(values, idx: str) -> str:
    lst = "[" + ", ".join(S.lit(v) if isinstance(v, str) else str(v) for v in values) + "]"
    return f"({lst})[({idx}) % {len(values)} + 1]"


def js_url(page_url: str = "url", pid: str = "page_id") -> str:
    return (f"{S.scheme(page_url)} || '://' || {S.authority(page_url)} || '/static/js/app-' "
            f"|| CAST({pid} AS VARCHAR) || '.js'")


def map_url(u: str) -> str:
    return f"(split_part({u}, '?', 1) || '.map')"


def responses_cte(with_seed: bool = True) -> str:
    body = (f"CASE WHEN regexp_matches(url, '(?i)graphql') THEN {S.lit(O.GRAPHQL_BODY)} "
            f"WHEN regexp_matches(url, '(?i)swagger') THEN {S.lit(O.SWAGGER_BODY)} ELSE 'ok' END")
    seed = S.seed_urls_cte() + "," if with_seed else ""
    return f"""{seed}
responses AS (
  SELECT p.url, {pick(O.STATUS_CYCLE, 'p.page_id')} AS status,
    regexp_extract(p.html, '<title>([^<]*)</title>', 1) AS title,
    CASE WHEN pt.p_partkey IS NULL THEN CAST([] AS VARCHAR[])
         ELSE [{pick(O.TECH_STACKS, "CAST(regexp_extract(pt.p_brand, '([0-9]+)$', 1) AS INTEGER)")},
               {pick(O.LIBRARIES, 'pt.p_size')}] END AS tech,
    {pick(O.SERVERS, 'p.page_id')} AS web_server, CAST(length(p.html) AS BIGINT) AS content_length,
    p.html AS body
  FROM pages p LEFT JOIN part pt ON p.page_id = pt.p_partkey
  UNION ALL
  SELECT url, {pick(O.STATUS_CYCLE, 'page_id + 3')}, '', CAST([] AS VARCHAR[]),
    {pick(O.SERVERS, 'page_id')}, CAST(length({body}) AS BIGINT), {body}
  FROM seed_urls
  UNION ALL
  SELECT {map_url(js_url())}, CASE WHEN page_id % 3 = 0 THEN 200 ELSE 404 END, '',
    CAST([] AS VARCHAR[]), {pick(O.SERVERS, 'page_id')}, CAST(13 AS BIGINT), '{{"version":3}}'
  FROM pages
)"""


def source_maps_cte() -> str:
    seed = "[" + ", ".join(S.lit(s) for s in O.SEED_SOURCES) + "]"
    return f"""
source_maps AS (
  SELECT {map_url(js_url())} AS map_url,
    list_concat({seed}, list_transform(regexp_extract_all(html, 'href="(/[^"]*)"', 1),
                                      lambda x: 'webpack:///src/pages' || x || '.jsx')) AS sources
  FROM pages
)"""


def headers_cte() -> str:
    edge = ("CASE WHEN web_server = 'AmazonS3' THEN 'X-Amz-Cf-Pop: FRA2' "
            "WHEN web_server = 'Varnish' THEN 'X-Served-By: cache-fastly-fra' "
            "WHEN web_server = 'gws' THEN 'Via: 1.1 akamai edge' ELSE 'Cache-Control: no-cache' END")
    return f"""
response_headers AS (
  SELECT {S.host('url')} AS host,
    unnest(['Server: ' || web_server, 'X-Request-Id: ' || substr(md5(url), 1, 16), {edge}]) AS line
  FROM responses WHERE len(tech) > 0
)"""
