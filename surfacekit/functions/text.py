"""Text, IP and formatting column expressions (PRJ3, PRJ9-PRJ15, FLT16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surfacekit import rules

HTTP_URL = r"https?://[^ \t\n\f\r]+"
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_ANCHORED = r"^" + _OCTET + r"(\." + _OCTET + r"){3}$"
# a run of digits and dots; without a repeated group it needs no stack on long runs
DOTTED_RUN = r"[0-9][0-9.]*"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_ipv4(col) -> Column:
    """FLT16: four dotted groups, anchored, with octet range check."""
    return _c(col).rlike(IPV4_ANCHORED)


def ipv4_to_long(col) -> Column:
    """Dotted quad -> BIGINT (null when not an address)."""
    parts = F.split(_c(col), r"\.")
    n = (F.element_at(parts, 1).cast("bigint") * 16777216
         + F.element_at(parts, 2).cast("bigint") * 65536
         + F.element_at(parts, 3).cast("bigint") * 256
         + F.element_at(parts, 4).cast("bigint"))
    return F.when(is_ipv4(col), n)


def extract_http_urls(text) -> Column:
    """PRJ3: every http(s):// non-space run in the text (array)."""
    return F.regexp_extract_all(_c(text), F.lit(HTTP_URL), 0)


def extract_ipv4(text) -> Column:
    """PRJ9 (strict, fixes the missing-dot quirk): dotted digit groups that are complete
    addresses."""
    return F.filter(dotted_groups(text), lambda x: x.rlike(IPV4_ANCHORED))


def dotted_groups(text) -> Column:
    """Maximal digit groups joined by single dots, without dots at their ends."""
    runs = F.regexp_extract_all(_c(text), F.lit(DOTTED_RUN), 0)
    return F.filter(F.flatten(F.transform(runs, lambda r: F.split(F.rtrim(r, F.lit(".")), r"\.\.+"))), lambda x: x != "")


def match_key(col) -> Column:
    """PRJ10: strip quotes, whitespace, '=', ':' and ';' (null when shorter than 8)."""
    k = F.regexp_replace(_c(col), rules.MATCH_KEY_STRIP, "")
    return F.when(F.length(k) >= rules.MATCH_KEY_MIN, k)


# a token-like run (>= 12 characters of key alphabets): first 4 kept, rest redacted
TOKEN_RUN = r"([A-Za-z0-9_+/-]{4})[A-Za-z0-9_+/-]{8,}"


def strip_ws(col) -> Column:
    """Python-style strip of ASCII whitespace on both ends."""
    return F.regexp_replace(_c(col), r"^[ \t\n\r\f]+|[ \t\n\r\f]+$", "")


def context_window(text, offset, match_len, pad: int = rules.CONTEXT_PAD) -> Column:
    """PRJ11: ``pad`` characters each side of [offset, offset+len) (0-based offset), tidied."""
    t, o, n = _c(text), _c(offset), _c(match_len)
    start = F.greatest(F.lit(0), o - pad)
    end = F.least(F.length(t), o + n + pad)
    return tidy_context(F.substring(t, start + 1, end - start), redact=False)


def tidy_context(window, redact: bool = True) -> Column:
    """PRJ11: newlines -> space, stripped; when longer than 200: first 100 + '...' + last 60.
    Token-like runs that no rule matched are cut to four characters."""
    raw = _c(window)
    if redact:
        raw = F.regexp_replace(raw, TOKEN_RUN, "$1***")
    ctx = strip_ws(F.regexp_replace(raw, "\n", " "))
    return (F.when(F.length(ctx) > 200,
                   F.concat(F.substring(ctx, 1, 100), F.lit("..."),
                            F.substring(ctx, -60, 60)))
            .otherwise(ctx))


def mask_secret(col, key: str = rules.DIGEST_KEY) -> Column:
    """PRJ15 (ours, safety): first 4 characters + '***' + 8 hex of a keyed sha-256 of all."""
    c = _c(col)
    return F.concat(F.substring(c, 1, 4), F.lit("***"), F.substring(F.sha2(F.concat(F.lit(key), c), 256), 1, 8))


def format_duration(secs) -> Column:
    """PRJ13: 'Ns' under a minute, 'NmNs' under an hour, else 'NhNm'."""
    s = _c(secs).cast("bigint")
    return (F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
            .when(s < 3600, F.concat((s / 60).cast("bigint").cast("string"), F.lit("m"),
                                     (s % 60).cast("string"), F.lit("s")))
            .otherwise(F.concat((s / 3600).cast("bigint").cast("string"), F.lit("h"),
                                ((s % 3600) / 60).cast("bigint").cast("string"), F.lit("m"))))


def line_first_token(col) -> Column:
    """PRJ14: first whitespace token of a trimmed line."""
    return F.try_element_at(F.split(F.trim(_c(col)), r"[ \t]+"), F.lit(1))


def line_last_token(col) -> Column:
    """PRJ14: last token, only when the line has '[' and at least 3 tokens."""
    toks = F.split(F.trim(_c(col)), r"[ \t]+")
    return F.when(_c(col).contains("[") & (F.size(toks) >= 3),
                  F.try_element_at(toks, F.lit(-1)))


def display_passive(url, ip, server) -> Column:
    """PRJ12: 'url | ip | server' with empty defaults."""
    return F.concat_ws(" | ", F.coalesce(_c(url), F.lit("")), F.coalesce(_c(ip), F.lit("")),
                       F.coalesce(_c(server), F.lit("")))


def display_finding(tier, type_, url, match) -> Column:
    """PRJ12: '[tier] type | url | match'."""
    return F.concat(F.lit("["), _c(tier).cast("string"), F.lit("] "), _c(type_), F.lit(" | "),
                    _c(url), F.lit(" | "), _c(match))


def display_response(url, status, title) -> Column:
    """PRJ12: 'url (status) — title'."""
    return F.concat(_c(url), F.lit(" ("), _c(status).cast("string"), F.lit(") — "),
                    F.coalesce(_c(title), F.lit("")))
