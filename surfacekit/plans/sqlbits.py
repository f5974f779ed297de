"""Building blocks for the DuckDB oracle statements.

The oracle is written independently in SQL; only the rule catalogs (fixed values) are
shared with the Spark side. Patterns are used in their portable (RE2) form.
"""

from __future__ import annotations

from surfacekit import rules


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ci(pattern: str) -> str:
    return lit(pattern if pattern.startswith("(?i)") else "(?i)" + pattern)


def scheme(u: str) -> str:
    return f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1))"


def authority(u: str) -> str:
    return f"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"


def host(u: str) -> str:
    return f"lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)', 2))"


def port(u: str) -> str:
    return f"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?[^/?#:]*:([0-9]+)', 2)"


def path(u: str) -> str:
    return f"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def query(u: str) -> str:
    return f"regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1)"


def fragment(u: str) -> str:
    return f"regexp_extract({u}, '^[^#]*#(.*)$', 1)"


WS = "[ \\t\\n\\f\\r]"
# comments, and the text of scripts and style sheets, give no links
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|(<script(?:[ \t\n\f\r/][^<>]*)?>).*?(?:</script|\z)|(<style(?:[ \t\n\f\r/][^<>]*)?>).*?(?:</style|\z)"
TAG = "<[A-Za-z][^<>]*>"
ATTRIBUTE = rf"""[^ \t\n\f\r"'<>/=]+(?:{WS}*={WS}*(?:"[^"]*"|'[^']*'|[^ \t\n\f\r"'<>]+))?"""


def decoded(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '(?i)&amp;|&#38;|&#x26;', '&', 'g'), '(?i)&quot;|&#34;', '\"', 'g')"


def resolved(base: str, link: str) -> str:
    """RFC 3986 reference resolution; dot segments by folding the list of segments."""
    bare = f"regexp_replace({link}, '#.*$', '')"
    query = f"regexp_extract({bare}, '(\\?.*)$', 1)"
    path_ = f"regexp_replace({bare}, '\\?.*$', '')"
    root = f"{scheme(base)} || '://' || {authority(base)}"
    joined = (f"CASE WHEN starts_with({path_}, '/') THEN {path_} "
              f"ELSE coalesce(nullif(regexp_extract({path(base)}, '^(.*/)', 1), ''), '/') || {path_} END")
    segs = f"string_split(substr({joined}, 2), '/')"
    kept = (f"list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform({segs}, lambda s: [s])), lambda acc, x: "
            f"CASE WHEN x[1] = '.' THEN acc WHEN x[1] = '..' THEN acc[1:len(acc) - 1] ELSE list_concat(acc, x) END)")
    flat = f"'/' || array_to_string({kept}, '/') || CASE WHEN {segs}[-1] IN ('.', '..') AND len({kept}) > 0 THEN '/' ELSE '' END"
    return f"""CASE WHEN {link} = '' OR regexp_matches({link}, '(?i)^(#|javascript:|mailto:|data:|tel:)') THEN NULL
      WHEN regexp_matches({bare}, '(?i)^[a-z][a-z0-9+.-]*:') THEN {bare}
      WHEN starts_with({bare}, '//') THEN {scheme(base)} || ':' || {bare}
      WHEN {path_} = '' THEN {root} || CASE WHEN {path(base)} = '' THEN '/' ELSE {path(base)} END || {query}
      ELSE {root} || {flat} || {query} END"""


def _value(attribute: str) -> str:
    raw = f"regexp_extract({attribute}, '(?s)^[^=]*={WS}*(.*)$', 1)"
    bare = f"CASE WHEN {raw}[1] IN (chr(34), chr(39)) THEN substr({raw}, 2, length({raw}) - 2) ELSE {raw} END"
    return f"trim({decoded(bare)})"


PAGE_LINKS = f"""
links_tags AS (
  SELECT page_id, url AS page_url, regexp_extract_all(regexp_replace(html, {lit(HIDDEN)}, '\\1\\2', 'g'), {lit(TAG)}) AS tags FROM pages
),
links_own AS (
  SELECT page_id, page_url, tags, list_filter(flatten(list_transform(list_filter(tags, lambda t: regexp_matches(t, '(?i)^<base[ \t\n\f\r/>]')),
    lambda t: regexp_extract_all(regexp_extract(t, '(?s)^<[A-Za-z][^<>/ \t\n\f\r]*([^<>]*)>$', 1), {lit(ATTRIBUTE)}))),
    lambda x: regexp_matches(x, '(?i)^href{WS}*=')) AS own FROM links_tags
),
links_base AS (
  SELECT page_id, page_url, tags, CASE WHEN len(own) > 0 THEN {_value('own[1]')} ELSE '' END AS own_base FROM links_own
),
links_raw AS (
  SELECT page_id, page_url, base, {_value('attribute')} AS link FROM (
    SELECT page_id, page_url, CASE WHEN own_base <> '' THEN coalesce({resolved('page_url', 'own_base')}, page_url) ELSE page_url END AS base,
      unnest(flatten(list_transform(tags, lambda t: regexp_extract_all(regexp_extract(t, '(?s)^<[A-Za-z][^<>/ \t\n\f\r]*([^<>]*)>$', 1), {lit(ATTRIBUTE)})))) AS attribute
    FROM links_base)
  WHERE regexp_matches(attribute, '(?i)^(href|src|action){WS}*=')
),
links_res AS (SELECT page_id, page_url, link, {resolved('base', 'link')} AS url FROM links_raw),
page_links AS (
  SELECT page_id, page_url, link, url FROM links_res
  WHERE url IS NOT NULL AND url <> '' AND regexp_matches(url, '(?i)^https?://')
)"""


def seed_paths_sql() -> str:
    from surfacekit.sources.tables import SEED_PATHS
    return "[" + ", ".join(lit(p) for p in SEED_PATHS) + "]"


def seed_urls_cte() -> str:
    from surfacekit.sources.tables import SEED_PATHS
    n = len(SEED_PATHS)
    return f"""
seed_urls AS (
  SELECT page_id, {scheme('url')} || '://' || {authority('url')}
         || ({seed_paths_sql()})[(page_id % {n}) + 1] AS url
  FROM pages
)"""


def url_sources_cte() -> str:
    return f"""{PAGE_LINKS},{seed_urls_cte()},
url_sources AS (
  SELECT url, 'page' AS source FROM pages
  UNION ALL SELECT url, 'link' FROM page_links
  UNION ALL SELECT url, 'seed' FROM seed_urls
),
url_corpus AS (
  SELECT url, {host('url')} AS host FROM (SELECT DISTINCT url FROM url_sources)
)"""


def tag_list(col: str, url_rules=rules.ALL_URL_RULES) -> str:
    items = ", ".join(f"CASE WHEN regexp_matches({col}, {ci(r.pattern)}) THEN {lit(r.tag)} END"
                      for r in url_rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def url_tags_cte() -> str:
    return f"""{url_sources_cte()},
url_tags AS (
  SELECT url, host, unnest({tag_list('url')}) AS tag FROM url_corpus
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"
