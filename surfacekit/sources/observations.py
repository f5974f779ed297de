"""Recorded observations derived from the driver tables.

The original collects these with network tools; here they are tables Spark derives from
``pages``, ``part`` and ``events`` so that every query over them grows with the data.
Small fixed value lists (technology names, status cycle) are indexed per row by a value
of that row -- expanded with ``element_at``, never joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surfacekit.functions.urls import source_map_url, url_authority, url_host, url_scheme
from surfacekit.sources import tables as T

TECH_STACKS = ("nginx", "Laravel", "WordPress", "Jenkins", "Jira", "Django", "Spring Boot",
               "Kubernetes", "React", "GraphQL", "Apache", "Express")
LIBRARIES = ("jQuery", "Bootstrap", "React", "Vue.js", "Google Analytics", "Font Awesome",
             "Lodash")
SERVERS = ("nginx", "Apache", "cloudflare", "Microsoft-IIS/10.0", "AmazonS3", "Varnish", "gws")
STATUS_CYCLE = (200, 200, 301, 302, 403, 404, 401, 500, 200, 405)
SEED_SOURCES = ("webpack:///src/api/client.js", "webpack:///src/auth/session.js",
                "webpack:///src/components/Header.jsx", "webpack:///src/config/env.js",
                "webpack:///node_modules/react/index.js", "webpack:///src/payments/checkout.js",
                "webpack:///src/admin/users.js", "webpack:///src/utils/format.js")
GRAPHQL_BODY = '{"data":{"__schema":{"queryType":{"name":"Query"}}}}'
SWAGGER_BODY = '{"swagger":"2.0","info":{"title":"api"}}'


def _pick(values, idx_col):
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(idx_col, F.lit(len(values))) + 1).cast("int"))


def js_urls(spark, d) -> DataFrame:
    """(page_id, url) of the script derived from each page."""
    p = T.pages(spark, d)
    return p.select("page_id", F.concat(url_scheme("url"), F.lit("://"), url_authority("url"),
                                        F.lit("/static/js/app-"), F.col("page_id").cast("string"),
                                        F.lit(".js")).alias("url"))


def responses(spark, d) -> DataFrame:
    """responses(url, status, title, tech, web_server, content_length, body)."""
    p = T.pages(spark, d)
    part = T.load(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    brand = F.regexp_extract("p_brand", r"([0-9]+)$", 1).cast("int")
    page_resp = (p.join(part, p.page_id == part.p_partkey, "left")
                 .select("url", _pick(STATUS_CYCLE, F.col("page_id")).alias("status"),
                         F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
                         F.when(F.col("p_partkey").isNull(), F.array().cast("array<string>"))
                         .otherwise(F.array(_pick(TECH_STACKS, brand), _pick(LIBRARIES, F.col("p_size"))))
                         .alias("tech"),
                         _pick(SERVERS, F.col("page_id")).alias("web_server"),
                         F.length("html").cast("bigint").alias("content_length"),
                         F.col("html").alias("body")))
    seed = T.seed_urls(spark, d)
    body = (F.when(F.col("url").rlike("(?i)graphql"), F.lit(GRAPHQL_BODY))
            .when(F.col("url").rlike("(?i)swagger"), F.lit(SWAGGER_BODY)).otherwise(F.lit("ok")))
    seed_resp = seed.select("url", _pick(STATUS_CYCLE, F.col("page_id") + 3).alias("status"),
                            F.lit("").alias("title"), F.array().cast("array<string>").alias("tech"),
                            _pick(SERVERS, F.col("page_id")).alias("web_server"),
                            F.length(body).cast("bigint").alias("content_length"), body.alias("body"))
    maps = js_urls(spark, d)
    map_resp = maps.select(source_map_url("url").alias("url"),
                           F.when(F.pmod("page_id", F.lit(3)) == 0, 200).otherwise(404).alias("status"),
                           F.lit("").alias("title"), F.array().cast("array<string>").alias("tech"),
                           _pick(SERVERS, F.col("page_id")).alias("web_server"),
                           F.lit(13).cast("bigint").alias("content_length"),
                           F.lit('{"version":3}').alias("body"))
    return page_resp.unionByName(seed_resp).unionByName(map_resp)


def source_maps(spark, d) -> DataFrame:
    """source_maps(map_url, sources): seeded originals followed by one module per nav link."""
    p = T.pages(spark, d)
    js = F.concat(url_scheme("url"), F.lit("://"), url_authority("url"), F.lit("/static/js/app-"),
                  F.col("page_id").cast("string"), F.lit(".js"))
    nav = F.transform(F.regexp_extract_all("html", F.lit(r'href="(/[^"]*)"'), 1),
                      lambda x: F.concat(F.lit("webpack:///src/pages"), x, F.lit(".jsx")))
    return p.select(source_map_url(js).alias("map_url"),
                    F.concat(F.array(*[F.lit(s) for s in SEED_SOURCES]), nav).alias("sources"))


def hosts_of_pages(spark, d) -> DataFrame:
    return T.pages(spark, d).select(url_host("url").alias("host")).distinct()


def response_headers(spark, d) -> DataFrame:
    """response_headers(host, line): three header lines per page response."""
    r = responses(spark, d).where(F.size("tech") > 0)
    edge = (F.when(F.col("web_server") == "AmazonS3", F.lit("X-Amz-Cf-Pop: FRA2"))
            .when(F.col("web_server") == "Varnish", F.lit("X-Served-By: cache-fastly-fra"))
            .when(F.col("web_server") == "gws", F.lit("Via: 1.1 akamai edge"))
            .otherwise(F.lit("Cache-Control: no-cache")))
    lines = F.array(F.concat(F.lit("Server: "), F.col("web_server")),
                    F.concat(F.lit("X-Request-Id: "), F.substring(F.md5("url"), 1, 16)), edge)
    return r.select(url_host("url").alias("host"), F.explode(lines).alias("line"))
