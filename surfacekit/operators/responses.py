"""Operators over recorded HTTP responses: ARR5, AGG1, WIN1, WIN5, JN1, JN4."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surfacekit.functions.urls import url_authority, url_scheme


def explode_tech(resp: DataFrame) -> DataFrame:
    """ARR5: one row per (response, technology)."""
    return resp.select("url", F.explode(F.coalesce("tech", F.array().cast("array<string>")))
                       .alias("tech"))


def tech_summary(resp: DataFrame) -> DataFrame:
    """AGG1: responses per technology (partial aggregation map-side)."""
    return explode_tech(resp).groupBy("tech").agg(F.count("*").alias("responses"))


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """WIN5: sorted truncation; planned as TakeOrderedAndProject (per-partition top-k, then
    a k-row merge), never a full sort on one task."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: str, order: Sequence, k: int, most: int) -> DataFrame:
    """WIN5 with a cap per group: the first ``k`` rows in ``order`` among each group's first ``most``, so that
    one host does not fill the sample. Null groups are one group; ties go by the order given, which should
    end in a key. Both limits are partial before their shuffle, so a group of a third of all rows sends
    ``most`` rows a task."""
    w = Window.partitionBy(group).orderBy(*order)
    at = "place in group"
    return top_k(df.withColumn(at, F.row_number().over(w)).where(F.col(at) <= most).drop(at), order, k)


def top_technologies(resp: DataFrame, k: int = 15) -> DataFrame:
    return top_k(tech_summary(resp), [F.desc("responses"), F.asc("tech")], k)


def tech_examples(resp: DataFrame, k: int = 20) -> DataFrame:
    """WIN1: at most ``k`` URLs per technology in URL order (partial window-group limit
    before the shuffle keeps a dominant technology from flooding one task)."""
    w = Window.partitionBy("tech").orderBy("url")
    return explode_tech(resp).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# Technology keys whose presence triggers hints; the wording is ours (defensive checks).
TECH_KEYS = ("laravel", "wordpress", "jenkins", "jira", "django", "spring", "kubernetes",
             "nginx", "react", "graphql")
TECH_HINTS = (
    ("laravel", "confirm the .env file and debug panels are not served"),
    ("laravel", "confirm queue and storage consoles require authentication"),
    ("wordpress", "confirm user listing through the REST API is disabled"),
    ("wordpress", "review exposed upload folders and xmlrpc"),
    ("jenkins", "confirm the script console and management pages need authentication"),
    ("jira", "confirm project and user search are not anonymous"),
    ("django", "confirm DEBUG is off and the admin is not public"),
    ("spring", "confirm actuator endpoints are not public"),
    ("spring", "review published API documentation"),
    ("kubernetes", "confirm kubelet and etcd ports are not reachable"),
    ("nginx", "review alias and proxy rules for path traversal"),
    ("react", "confirm source maps are not deployed"),
    ("react", "review bundled configuration for keys"),
    ("graphql", "confirm introspection and consoles are disabled in production"),
)
NO_HINT = "no technology-specific hints"


def hint_table(spark) -> DataFrame:
    rows = [(k, i, h) for i, (k, h) in enumerate(TECH_HINTS)]
    return spark.createDataFrame(rows, "tech_key string, hint_ord int, hint string")


def tech_hints(resp: DataFrame) -> DataFrame:
    """JN1: theta semi-join -- a hint applies when its key is a substring of any
    lower-cased technology; one row per hint in hint order; one fallback row when none.

    The fixed-size hint table is the broadcast side; the distinct technologies stream."""
    spark = resp.sparkSession
    techs = explode_tech(resp).select(F.lower("tech").alias("t")).distinct()
    hints = F.broadcast(hint_table(spark))
    matched = (techs.join(hints, F.instr(F.col("t"), F.col("tech_key")) > 0, "inner")
               .select("tech_key", "hint_ord", "hint").distinct())
    none = (matched.agg(F.count("*").alias("n")).where(F.col("n") == 0)
            .select(F.lit("none").alias("tech_key"), F.lit(-1).alias("hint_ord"),
                    F.lit(NO_HINT).alias("hint")))
    return matched.unionByName(none)


# FIXED VALUES: API documentation paths probed on every live host.
API_DOC_PATHS = (
    "/swagger.json", "/swagger.yaml", "/swagger-ui.html", "/swagger-ui/",
    "/api-docs", "/api-docs.json", "/openapi.json", "/openapi.yaml",
    "/v1/swagger.json", "/v2/api-docs", "/v3/api-docs", "/api/swagger",
    "/docs", "/redoc", "/api/redoc", "/.well-known/openapi", "/graphql",
    "/graphiql", "/api/graphql", "/__graphql", "/graphql/console", "/v1",
    "/v2", "/v3", "/api", "/api/v1", "/api/v2", "/api/v3", "/rest",
    "/rest/v1", "/rest/v2", "/rpc", "/json-rpc", "/soap", "/wsdl",
    "/.well-known/api",
)
# FIXED VALUES: API version paths.
API_VERSION_PATHS = ("/v1", "/v2", "/v3", "/v4", "/api/v1", "/api/v2", "/api/v3")


def expected_paths(live: DataFrame, resp: DataFrame, paths: Sequence[str] = API_DOC_PATHS) -> DataFrame:
    """JN4 (re-aimed): every live base URL (scheme and authority, with its port) x each expected
    path -- generated with a generator over a literal array, not a join -- then a left join to
    the recorded responses, one per URL (the smallest status): coverage (seen or not, status)."""
    bases = live.select(F.concat(url_scheme("url"), F.lit("://"), F.lower(url_authority("url"))).alias("base")).distinct()
    cand = bases.select("base", F.explode(F.array(*[F.lit(p) for p in paths])).alias("path"))
    cand = cand.withColumn("url", F.concat("base", "path"))
    r = resp.groupBy("url").agg(F.min("status").alias("status"))
    return (cand.join(r, "url", "left")
            .select("base", "path", "url", F.col("status").isNotNull().alias("seen"), "status"))
