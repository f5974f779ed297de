"""URL and host column expressions (PRJ1, PRJ2, PRJ4, PRJ6, PRJ7, PRJ8).

All are built-in Spark expressions (JVM side, whole-stage codegen); none parses with
``parse_url``, which throws on malformed input under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*)://"
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)"
_PORT = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?[^/?#:]*:([0-9]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"
_FRAGMENT = r"^[^#]*#(.*)$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def url_scheme(url) -> Column:
    return F.lower(F.regexp_extract(_c(url), _SCHEME, 1))


def url_authority(url) -> Column:
    return F.regexp_extract(_c(url), _AUTHORITY, 1)


def url_host(url) -> Column:
    return F.lower(F.regexp_extract(_c(url), _HOST, 2))


def url_port(url) -> Column:
    return F.regexp_extract(_c(url), _PORT, 2)


def url_path(url) -> Column:
    return F.regexp_extract(_c(url), _PATH, 1)


def url_query(url) -> Column:
    return F.regexp_extract(_c(url), _QUERY, 1)


def url_fragment(url) -> Column:
    return F.regexp_extract(_c(url), _FRAGMENT, 1)


def url_parts(df, col: str = "url"):
    """PRJ4: scheme / host / port / path / query / fragment columns."""
    u = F.col(col)
    return df.select("*", url_scheme(u).alias("scheme"), url_host(u).alias("host"),
                     url_port(u).alias("port"), url_path(u).alias("path"),
                     url_query(u).alias("query"), url_fragment(u).alias("fragment"))


def normalize_target(col) -> Column:
    """PRJ1: lower, trim, strip leading '*' / '.' characters."""
    return F.regexp_replace(F.lower(F.trim(_c(col))), r"^[*.]+", "")


def is_wildcard(col) -> Column:
    return F.trim(_c(col)).startswith("*.")


def org_name(col) -> Column:
    """PRJ2: organisation = first label of the normalised target."""
    return F.split_part(normalize_target(col), F.lit("."), F.lit(1))


def name_parts(col) -> Column:
    """PRJ2: '-' and '_' treated as '.', then split into parts."""
    return F.split(F.translate(normalize_target(col), "-_", ".."), r"\.")


def url_key(url) -> Column:
    """PRJ6: collapse URL variants: no scheme, lower host without 'www.', no fragment,
    query parameters sorted."""
    u = _c(url)
    host = F.regexp_replace(url_host(u), r"^www\.", "")
    port = url_port(u)
    q = url_query(u)
    sorted_q = F.array_join(F.array_sort(F.split(q, "&")), "&")
    return F.concat(host, F.when(port != "", F.concat(F.lit(":"), port)).otherwise(F.lit("")),
                    url_path(u),
                    F.when(q != "", F.concat(F.lit("?"), sorted_q)).otherwise(F.lit("")))


def source_map_url(url) -> Column:
    """PRJ7: cut at '?', append '.map'."""
    return F.concat(F.split_part(_c(url), F.lit("?"), F.lit(1)), F.lit(".map"))


def safe_name(col) -> Column:
    """PRJ8: file-safe name: '://', '/', ':' -> '_'."""
    return F.regexp_replace(F.regexp_replace(_c(col), "://", "_"), "[/:]", "_")


def short_hash(col, n: int = 8) -> Column:
    """PRJ8: first n hex characters of md5."""
    return F.substring(F.md5(_c(col)), 1, n)
