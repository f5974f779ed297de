"""Endpoint engine and cloud references (EXT6, EXT7, EXT8, SET3, WIN2, PRJ7, ARR4, JN7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.functions.text import strip_ws
from surfacekit.functions.urls import source_map_url


def extract_endpoints(corpus: DataFrame, text_col: str = "content", keep: tuple[str, ...] = ()) -> DataFrame:
    """EXT6: the four call-site shapes, trimmed, three characters or more, static assets
    dropped, distinct (with the ``keep`` columns, such as the url of the file that holds it). One projection (literal patterns), one distinct aggregate."""
    t = F.col(text_col)
    eps = F.flatten(F.array(*[
        F.regexp_extract_all(t, F.lit(rules.java_form(p)), 1) for p in rules.ENDPOINT_PATTERNS]))
    ep = strip_ws(F.col("ep"))
    return (corpus.select(*keep, F.explode(eps).alias("ep")).select(*keep, ep.alias("endpoint"))
            .where((F.length("endpoint") >= 3) & ~F.col("endpoint").rlike("(?i)" + rules.ENDPOINT_STATIC))
            .distinct())


def cluster_of(col: str | Column, extra: tuple[tuple[str, str], ...] = ()) -> Column:
    """EXT7: first matching cluster in rule order, else 'other'. ``extra`` (name, pattern) rules
    come before the catalog's."""
    c = F.col(col) if isinstance(col, str) else col
    out = F.lit("other")
    for name, pat in reversed((*extra, *rules.ENDPOINT_CLUSTERS)):
        out = F.when(c.rlike(pat), F.lit(name)).otherwise(out)
    return out


def cluster_endpoints(eps: DataFrame, col: str = "endpoint", extra: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    return eps.withColumn("cluster", cluster_of(col, extra))


def merge_endpoints(engine: DataFrame, tool_lines: DataFrame, line_col: str = "line") -> DataFrame:
    """SET3: engine endpoints union another tool's lines that start with '/' and are
    longer than 2 characters; distinct; clustered."""
    extra = (tool_lines.select(F.trim(F.col(line_col)).alias("endpoint"))
             .where(F.col("endpoint").startswith("/") & (F.length("endpoint") > 2)))
    return cluster_endpoints(engine.select("endpoint").unionByName(extra).distinct())


def endpoint_examples(clustered: DataFrame, k: int = 10,
                      clusters=rules.HIGH_VALUE_CLUSTERS) -> DataFrame:
    """WIN2: first ``k`` sorted endpoints for each high-value cluster. The ``rank <= k``
    filter lets Spark insert a partial window-group limit before the shuffle, so a huge
    cluster sends at most k rows per map task."""
    w = Window.partitionBy("cluster").orderBy("endpoint")
    return (clustered.where(F.col("cluster").isin(list(clusters)))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))


# Cloud storage hostnames besides S3 (provider, pattern), lower-case text.
CLOUD_HOST_PATTERNS = (
    ("azure", r"[a-z0-9]{3,24}\.blob\.core\.windows\.net"),
    ("gcs", r"storage\.googleapis\.com/[a-z0-9._-]{3,}"),
    ("firebase", r"[a-z0-9-]{4,}\.firebaseio\.com"),
)


def _tagger(provider: str):
    return lambda x: F.struct(F.lit(provider).alias("provider"), x.alias("ref"))


def cloud_references(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """EXT8: S3 URIs / virtual-host bucket names (and Azure / GCS / Firebase hosts) in the
    union of URL and script text, distinct (provider, ref)."""
    t = F.col(text_col)
    found = F.array(
        F.transform(F.regexp_extract_all(t, F.lit(rules.S3_REFERENCE), 0),
                    lambda x: F.struct(F.lit("s3").alias("provider"), x.alias("ref"))),
        *[F.transform(F.regexp_extract_all(F.lower(t), F.lit(p), 0), _tagger(name))
          for name, p in CLOUD_HOST_PATTERNS])
    return (texts.select(F.explode(F.flatten(found)).alias("r"))
            .select("r.provider", "r.ref").distinct())


# FIXED VALUES: interesting original-source names in a source map.
INTERESTING_SOURCE = r"(?i)(api|auth|config|secret|token|key|pay|admin)"


def explode_source_map(maps: DataFrame) -> DataFrame:
    """ARR4: every interesting original file of every map, with its position in the map and
    its rank among the map's interesting ones. Within the map's own array: no shuffle."""
    numbered = F.transform("sources", lambda s, i: F.struct(i.alias("pos"), s.alias("source")))
    flagged = F.filter(numbered, lambda x: x["source"].rlike(INTERESTING_SOURCE))
    e = maps.select("map_url", F.posexplode(flagged).alias("before", "s"))
    return e.select("map_url", "s.pos", "s.source", (F.col("before") + 1).alias("rank"))


def exposed_source_maps(js: DataFrame, responses: DataFrame, url_col: str = "url") -> DataFrame:
    """JN7: script URL -> '.map' URL, inner equi-join with recorded 200 responses."""
    maps = js.select(F.col(url_col).alias("js_url"), source_map_url(url_col).alias("map_url"))
    ok = responses.where(F.col("status") == 200).select(F.col("url").alias("map_url"))
    return maps.join(ok, "map_url", "inner")
