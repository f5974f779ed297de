"""Filters and predicates (FLT1-FLT16). DataFrame in -> DataFrame out, narrow, pushed-down
where the predicate allows it. Regex predicates are literal ``rlike`` patterns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.functions.text import is_ipv4

LABEL = r"[a-zA-Z0-9](?:[a-zA-Z0-9\-]{0,61}[a-zA-Z0-9])?"


def _ci(pattern: str) -> str:
    return pattern if pattern.startswith("(?i)") else "(?i)" + pattern


def matches(col: str | Column, pattern: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(_ci(rules.java_form(pattern)))


def valid_hostnames(df: DataFrame, col: str = "host") -> DataFrame:
    """FLT1: RFC-style labels (alnum ends, inner hyphens, <= 63 chars per label). Label by
    label, so that the pattern needs no stack on names of many labels."""
    return df.where(F.forall(F.split(F.col(col), r"\."), lambda x: x.rlike(f"^{LABEL}$")))


def in_scope_expr(host: Column, domain: Column) -> Column:
    h = F.lower(host)
    d = F.lower(domain)
    return (h == d) | F.endswith(h, F.concat(F.lit("."), d))


SPLITS = 16


def scope_suffixes(host: Column, depths: Column) -> Column:
    """The suffixes of a host with as many labels as some domain of the scope has (``depths``): what a
    walk of its reversed labels down a trie of the scope would look at."""
    labels = F.size(F.split(host, r"\."))
    return F.transform(F.filter(depths, lambda n: n <= labels), lambda n: F.call_function("substring_index", host, F.lit("."), -n))


def in_scope(df: DataFrame, col: str, domains: DataFrame, domain_col: str = "domain",
             keep: bool = True, splits: int = SPLITS) -> DataFrame:
    """FLT2 / JN12: exact domain or any dotted subdomain, case-insensitive.

    "host equals d or ends with '.d'" is the same as "d is a label suffix of host", so the
    theta condition becomes equi-joins: distinct hosts with their suffixes of the depths that the
    scope has (at most one a depth; mostly two or three), semi-joined with the scope, then the rows
    semi/anti-joined on the host. A suffix that holds all hosts is dealt out: a host's hash is
    part of the key, and the scope stands under each of its ``splits`` values. Neither side is
    assumed small (a scope derived from data can be large); AQE broadcasts at run time when a side
    turns out small. ``keep=False`` gives the out-of-scope rows. Null hosts are out of scope."""
    scope = domains.select(F.lower(F.trim(F.col(domain_col))).alias("_s")).where("_s is not null").distinct()
    depths = scope.agg(F.collect_set(F.size(F.split("_s", r"\.")))).scalar()
    hosts = df.select(F.lower(F.col(col)).alias("_h")).where("_h is not null").distinct().select("_h", depths.alias("_d"))
    dealt = scope.select("_s", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("_k"))
    hit = (hosts.select("_h", F.pmod(F.hash("_h"), F.lit(splits)).alias("_k"), F.explode(scope_suffixes(F.col("_h"), F.col("_d"))).alias("_s"))
           .join(dealt, ["_s", "_k"], "left_semi").select("_h").distinct())
    return df.join(hit, F.lower(df[col]) == hit["_h"], "left_semi" if keep else "left_anti")


def sensitive_files(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT3: URL ends in (or has '?' after) a document/archive/db/key/config extension."""
    return df.where(matches(col, rules.SENSITIVE_EXTS))


def high_impact_files(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT4: env / git / config / compose / manifest / dump files (segment-start fix)."""
    return df.where(matches(col, rules.HIGH_IMPACT_FILES))


def admin_panels(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT5: a path segment names an admin / ops product."""
    return df.where(matches(col, rules.ADMIN_PATTERN))


def api_endpoints(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT6: API-looking path."""
    return df.where(matches(col, rules.API_PATTERN))


def api_routes(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT7: narrower api / vN / rest / rpc routes, trimmed, distinct."""
    t = F.trim(F.col(col))
    return (df.select(t.alias(col)).where((F.col(col) != "") & matches(col, rules.API_ROUTE_PATTERN))
            .distinct())


def keyword_urls(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT8: URLs holding business / security keywords, with the keywords found."""
    kw = F.regexp_extract_all(F.lower(F.col(col)), F.lit(rules.KEYWORD_PATTERN), 1)
    return (df.where(matches(col, rules.KEYWORD_PATTERN))
            .withColumn("keywords", F.array_join(F.array_sort(F.array_distinct(kw)), ",")))


def js_urls(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT9: '.js' followed by end, '?' or '#'."""
    return df.where(matches(col, rules.JS_URL_PATTERN))


def drop_vendor_js(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT10: remove well-known frameworks and public CDNs."""
    return df.where(~matches(col, rules.VENDOR_JS_PATTERN))


def drop_static_assets(df: DataFrame, col: str = "url") -> DataFrame:
    """FLT11: remove images, fonts and stylesheets."""
    return df.where(~matches(col, rules.STATIC_ASSET_PATTERN))


# FIXED VALUES: accepted HTTP status sets.
LIVE_ENDPOINT_STATUS = (200, 201, 301, 302, 403)
SWEEP_STATUS = (200, 201, 301, 302, 403, 401, 404, 405, 500)
VERSION_PROBE_STATUS = (200, 201, 401, 403)


def live_responses(df: DataFrame, accepted: Iterable[int] = LIVE_ENDPOINT_STATUS,
                   col: str = "status") -> DataFrame:
    """FLT12 (re-aimed): keep recorded responses whose status is in ``accepted``."""
    return df.where(F.col(col).isin(list(accepted)))


DEFAULT_SEVERITIES = ("medium", "high", "critical")


def severity_filter(df: DataFrame, levels: Iterable[str] = DEFAULT_SEVERITIES,
                    exclude: bool = False, col: str = "severity") -> DataFrame:
    """FLT13: keep (or, with ``exclude``, drop) findings of the given severities."""
    cond = F.lower(F.col(col)).isin([x.lower() for x in levels])
    return df.where(~cond if exclude else cond)


# FIXED VALUES: tool log noise markers.
LOG_NOISE = ("[WRN]", "[INF]", "invalid semicolon")


def drop_log_noise(df: DataFrame, col: str = "line") -> DataFrame:
    """FLT14: drop blank lines and warning / info / parser-noise lines."""
    c = F.col(col)
    cond = F.trim(c) != ""
    for marker in LOG_NOISE:
        cond = cond & ~c.contains(marker)
    return df.where(cond)


def throttled_expr(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.contains("429") | F.lower(c).contains("rate limit")


def throttled(df: DataFrame, col: str = "line") -> DataFrame:
    """FLT15: lines reporting HTTP 429 or a rate limit."""
    return df.where(throttled_expr(col))


def ipv4_only(df: DataFrame, col: str = "ip") -> DataFrame:
    """FLT16 as a filter."""
    return df.where(is_ipv4(F.col(col)))
