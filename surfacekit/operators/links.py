"""EXT9 page_links: link extraction from stored HTML, resolved against the page URL.

Narrow (map-only) operator over Arrow batches, no shuffle. One pass of each whole page finds its
tags, one pass of each tag its attributes, and each link is resolved once; nothing of it is in the
query's expressions, so plans that use the links stay small.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The white space of HTML. Patterns are written so that Python's re and RE2 read them alike.
WS = "[ \\t\\n\\f\\r]"
#: Comments, and the text of scripts and style sheets, hold no links; the tags in front stay.
HIDDEN = (rf"(?is)<!--.*?(?:-->|\z)|(<script(?:[ \t\n\f\r/][^<>]*)?>).*?(?:</script|\z)|(<style(?:[ \t\n\f\r/][^<>]*)?>).*?(?:</style|\z)")
#: A start tag with its name and the text of its attributes.
TAG = r"<([A-Za-z][^<>/ \t\n\f\r]*)([^<>]*)>"
#: One attribute with its value, so that nothing inside a value is taken for an attribute.
ATTRIBUTE = rf"""[^ \t\n\f\r"'<>/=]+(?:{WS}*={WS}*(?:"[^"]*"|'[^']*'|[^ \t\n\f\r"'<>]+))?"""
LINK = rf"(?i)^(?:href|src|action){WS}*="
HREF = rf"(?i)^href{WS}*="
VALUE = rf"(?s)^[^=]*={WS}*(.*)$"
SKIP_LINK = r"(?i)^(#|javascript:|mailto:|data:|tel:)"

LINKS = "page_id long, page_url string, link string, url string"
_NAMES = [c.split()[0] for c in LINKS.split(", ")]

_HIDDEN, _TAG, _ATTRIBUTE = (re.compile(p.replace(r"\z", r"\Z")) for p in (HIDDEN, TAG, ATTRIBUTE))
_LINK, _HREF, _VALUE, _SKIP = (re.compile(p) for p in (LINK, HREF, VALUE, SKIP_LINK))
_AMP, _QUOTE = re.compile("(?i)&amp;|&#38;|&#x26;"), re.compile("(?i)&quot;|&#34;")
_ABSOLUTE, _WEB = re.compile(r"(?i)^[a-z][a-z0-9+.-]*:"), re.compile("(?i)^https?://")
_PARTS = re.compile(r"^(?:([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*))?", re.S)


def without_dots(path: str) -> str:
    """RFC 3986 5.2.4: "." segments go, ".." segments take the one before with them."""
    segments, kept = path[1:].split("/"), []
    for s in segments:
        if s == "..":
            kept = kept[:-1]
        elif s != ".":
            kept.append(s)
    return "/" + "/".join(kept) + ("/" if kept and segments[-1] in (".", "..") else "")


class Base:
    """A base URL, taken apart once; ``resolve`` follows RFC 3986 5.2: absolute, scheme-relative,
    rooted, query-only, relative, with dot segments. Fragments are dropped; skipped schemes and
    empty links give None."""

    def __init__(self, url: str | None) -> None:
        scheme, authority, path = _PARTS.match(url or "").groups(default="")
        self.scheme = scheme.lower()
        self.root = f"{self.scheme}://{authority}"
        self.path = path or "/"
        self.folder = path[: path.rfind("/") + 1] or "/"

    def resolve(self, link: str) -> str | None:
        if not link or _SKIP.match(link):
            return None
        bare = link.partition("#")[0]
        if _ABSOLUTE.match(bare):
            return bare
        if bare.startswith("//"):
            return f"{self.scheme}:{bare}"
        path, mark, query = bare.partition("?")
        if not path:
            return self.root + self.path + mark + query
        joined = path if path.startswith("/") else self.folder + path
        return self.root + (without_dots(joined) if "/." in joined else joined) + mark + query


def decoded(value: str) -> str:
    """The character references that URLs need."""
    return _QUOTE.sub('"', _AMP.sub("&", value)) if "&" in value else value


def value_of(attribute: str) -> str:
    raw = _VALUE.match(attribute)[1]
    if raw[:1] in ('"', "'"):
        raw = raw[1:-1]
    return decoded(raw).strip(" ")


def links_of(url: str | None, html: str | None) -> Iterator[tuple[str, str]]:
    """(link, resolved URL) of every href, src and action of a page, in order; the first
    ``<base href>`` is the base of all."""
    found, own = [], None
    for name, text in _TAG.findall(_HIDDEN.sub(lambda m: m[1] or m[2] or "", html or "")):
        if "=" in text:
            attributes = [x for x in _ATTRIBUTE.findall(text) if "=" in x]
            if own is None and name.lower() == "base":
                own = next((value_of(x) for x in attributes if _HREF.match(x)), None)
            found += [value_of(x) for x in attributes if _LINK.match(x)]
    base = Base(url)
    if own and (moved := base.resolve(own)):
        base = Base(moved)
    for link in found:
        resolved = base.resolve(link)
        if resolved and _WEB.match(resolved):
            yield link, resolved


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, page_url, link, url) for every href, src and action of every page that leads to a
    web URL. Comments, scripts, style sheets and attributes that only end like these (``data-src``,
    ``formaction``) give none. Null pages give no rows, null page URLs only absolute links;
    repeated pages give their links each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = [(i, url, *x) for i, url, html in zip(*(c.to_pylist() for c in part.columns)) for x in links_of(url, html)]
                columns = zip(*rows) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.string()] * 3))], _NAMES)

    return pages.select(F.col("page_id").cast("long"), F.col(url_col), F.col(html_col)).mapInArrow(run, LINKS)


# FIXED VALUES: robots / sitemap directives kept.
ROBOTS_DIRECTIVE = r"(?i)^(disallow|allow|sitemap)[ \t]*:[ \t]*([^ \t]+)"
SITEMAP_LOC = r"(?i)<loc>[ \t]*([^<]+?)[ \t]*</loc>"


def robots_paths(docs: DataFrame, host_col: str = "host", kind_col: str = "kind",
                 text_col: str = "text") -> DataFrame:
    """EXT10 (re-aimed): paths and sitemap URLs from stored robots.txt / sitemap text.
    (host, directive, value), from every line."""
    lines = docs.select(host_col, kind_col, F.explode(F.split(F.col(text_col), "\n")).alias("line"))
    robots = (lines.where(F.col(kind_col) == "robots")
              .select(host_col, F.lower(F.regexp_extract("line", ROBOTS_DIRECTIVE, 1)).alias("directive"),
                      F.regexp_extract("line", ROBOTS_DIRECTIVE, 2).alias("value")))
    sitemap = (lines.where(F.col(kind_col) == "sitemap")
               .select(host_col, F.lit("loc").alias("directive"),
                       F.explode(F.regexp_extract_all("line", F.lit(SITEMAP_LOC), 1)).alias("value")))
    return robots.where(F.col("directive") != "").unionByName(sitemap)


HUMANS_FIELD = r"^[ \t]*([^:\s][^:]*?)[ \t]*:[ \t]*(\S.*?)\s*$"


def humans_fields(docs: DataFrame, host_col: str = "host", kind_col: str = "kind", text_col: str = "text") -> DataFrame:
    """EXT10: the fields of stored humans.txt text, (host, section, field, value): ``Label: value`` lines,
    the label in lower case, under the upper-case name of the last ``/* SECTION */`` before them ('' before
    the first, or where a heading is not closed). Other lines, null and empty texts give no rows;
    repeated documents give their fields each. A document is split where it stands, never gathered."""
    parts = docs.where(F.col(kind_col) == "humans").select(host_col, F.posexplode(F.split(F.col(text_col), r"/\*")).alias("n", "part"))
    closed = (F.col("n") > 0) & F.contains("part", F.lit("*/"))
    section = F.when(closed, F.upper(F.trim(F.substring_index("part", "*/", 1)))).otherwise("")
    body = F.when(closed, F.expr("substr(part, instr(part, '*/') + 2)")).otherwise(F.col("part"))
    lines = parts.select(host_col, section.alias("section"), F.explode(F.split(body, "\n")).alias("line"))
    pick = lambda i: F.regexp_extract("line", HUMANS_FIELD, i)
    return lines.select(host_col, "section", F.lower(pick(1)).alias("field"), pick(2).alias("value")).where("field <> ''")
