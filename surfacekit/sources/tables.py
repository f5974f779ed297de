"""Driver tables and the logical tables Spark derives from them.

The logical tables of the data model (url corpus, script corpus, responses, findings,
phases, DNS and network observations, ...) are *derived* from the driver tables
(``pages``, ``documents``, ``events``, ``part``, ``supplier``, ...) so that every query's
work grows with its inputs. Seeded values (paths, script snippets) are small literal
arrays expanded per row with generators -- never a join against a literal table -- and any
token-like string is assembled from row-derived hashes at run time.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surfacekit.functions.urls import url_host, url_scheme, url_authority
from surfacekit.operators.links import page_links
from surfacekit.sources.io import union_sources

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


# Tables of long texts: read from few row groups they arrive in few partitions. A caller that
# wants more sets this (the bench does); unset, the read side decides.
TEXT_PARTITIONS = "surfacekit.text.partitions"
TEXT_TABLES = ("documents", "pages", "conversations")


class Part(str):
    """A table folder of which some tables show chosen files only: ``files`` has their paths by table."""

    files: dict[str, list[str]]

    def __new__(cls, sf_dir: str, files: dict[str, list[str]]):
        out = super().__new__(cls, sf_dir)
        out.files = files
        return out


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    chosen = getattr(sf_dir, "files", {}).get(name)
    df = spark.read.parquet(path) if chosen is None else spark.read.schema(spark.read.parquet(path).schema).parquet(*chosen) if chosen else spark.read.parquet(path).limit(0)
    n = spark.conf.get(TEXT_PARTITIONS, None) if name in TEXT_TABLES else None
    return df.repartition(int(n)) if n else df


# ---------------------------------------------------------------------------------------
# Seeded URL paths: one per page (index = page_id mod count), appended to the page's
# scheme://authority. Each URL category and quirk appears at least once.
SEED_PATHS = (
    "/.env",
    "/.git/config",
    "/backup/site-backup.tar.gz",
    "/db/dump.sql",
    "/docker-compose.yml",
    "/package.json",
    "/admin/login",
    "/administratorship",
    "/api/v2/users?id=17",
    "/rest/orders?order_id=5&sort=asc",
    "/graphql",
    "/swagger-ui.html",
    "/login?redirect=/account",
    "/item?uid=42&page=3",
    "/files/report.pdf",
    "/fetch?url=http://intranet.local/",
    "/search?q=shoes&lang=en",
    "/static/js/app.js",
    "/static/js/app.js?v=3",
    "/assets/vendor/jquery.min.js",
    "/img/logo.png",
    "/Admin/Panel/",
    "/docs/page#section",
    "/about",
    "/view?template=home",
    "/tools/ping?cmd=ls",
    "/status?debug=1",
    "/widget?callback=cb",
    "/upload?X-Amz-Credential=abc",
    "/proxy?image_url=https://media.s3.amazonaws.com/a.png",
    "/v1/accounts/profile?user=7",
    "/settings.py",
)


def pages(spark, d) -> DataFrame:
    return load(spark, d, "pages")


def seed_urls(spark, d) -> DataFrame:
    """(page_id, url): scheme://authority of each page + one seeded path."""
    p = pages(spark, d).select("page_id", "url")
    paths = F.array(*[F.lit(x) for x in SEED_PATHS])
    idx = F.pmod(F.col("page_id"), F.lit(len(SEED_PATHS))) + 1
    return p.select("page_id", F.concat(url_scheme("url"), F.lit("://"), url_authority("url"),
                                        F.element_at(paths, idx.cast("int"))).alias("url"))


def url_sources(spark, d) -> DataFrame:
    """(url, source) from three producers: page URLs, links in pages, seeded URLs.
    Not deduplicated (SET1 does that); the same URL may come from several sources."""
    p = pages(spark, d)
    return union_sources({"page": p, "link": page_links(p), "seed": seed_urls(spark, d)}, "url")


def url_corpus(spark, d) -> DataFrame:
    """Distinct URL corpus with host (SET1 over ``url_sources``)."""
    return url_sources(spark, d).select("url").distinct().select("url", url_host("url").alias("host"))


# ---------------------------------------------------------------------------------------
# Script corpus: one script per page, whole page HTML + seeded call sites and tokens.
# Placeholders are filled from row hashes at run time, so no credential-shaped literal is
# stored:  {K} host token, {P} page token (32 chars of md5 with digits mapped to g..p),
# {KU}/{PU} upper case, {N} page_id, {M} page_id mod 250, {O} first label of the host;
# {X:a:n} = substring(X, a, n).
SEED_SNIPPETS = (
    'const awsKey = "AKIA{KU:1:16}";',
    'aws_secret_access_key = "{K}{P:1:8}"',
    'var gkey = "AIza{P}abc";',
    'oauth = "ya29.{K}{P}";',
    'const gh = "ghp_{K}abcd";',
    'slack = "xoxb-{P:1:24}";',
    'stripe = "sk_live_{P:1:24}";',
    'stripePub = "pk_test_{K:1:24}";',
    'mail = "SG.{P:1:22}.{K}{P:1:11}";',
    'twilio = "AC{P}";',
    '-----BEGIN RSA PRIVATE KEY-----',
    'jwt = "eyJ{K:1:12}.eyJ{P:1:12}.{K:13:12}";',
    'mg = "key-{P}";',
    'shop = "shpss_{K}"; shop2 = "shpat_{P}";',
    'db = "https://{K:1:10}-db.firebaseio.com";',
    'conn = "postgres://app:{P:1:10}@db.internal:5432/main";',
    'headers = {"Authorization": "Bearer {P}"};',
    'apiKey = "{P:1:20}";',
    'client_secret: "{K:1:20}"',
    'access_token = "{P:5:20}"',
    'password = "{P:1:12}"',
    'bucket = "s3://{K:1:8}-backups"; cdn = "https://{K:1:8}-assets.s3.amazonaws.com/app.js";',
    'DefaultEndpointsProtocol=https;AccountName={K:1:10};AccountKey={P};',
    'assets = "https://{O}-assets.s3.amazonaws.com/logo.png"; rtdb = "https://{O}-app.firebaseio.com";',
    'internal = "10.0.{M}.12"; peer = "192.168.1.{M}"; ver = "1.10.0.1.2";',
    'gql = "/graphql";',
    'login = "{P:1:10}"',
    'client_id: "{K:1:16}"',
    'hook = "https://hooks.slack.com/services/{K:1:12}";',
    'mapbox = "pk.eyJ{P}";',
    'algolia_api_key = "{P:1:16}"',
    'api_key = "YOUR_API_KEY_HERE"; password = "xxxxxxxxxxxx";',
    'cache = "redis://cache.example.com:6379"; local = "mongodb://localhost:27017/db";',
    'fetch("/api/v1/users/{N}").then(r => r.json());',
    'axios.post("/auth/login", creds); axios.get("/admin/dashboard/stats");',
    'http.get("https://{K:1:6}.internal.example.net/v2/orders");',
    'const cfg = {endpoint: "/internal/metrics", url: "/upload/avatar", route: "/account/profile"};',
    'var x = new XMLHttpRequest, y = x.open("POST", "/payment/checkout?id={N}");',
    'hooks = {path: "/webhook/stripe", href: "/debug/health", src: "/data/export.csv"};',
    'icons = {href: "/static/img/logo.png", map: "/api/bundle.js.map"};',
    'fetch("/opsin/list"); fetch("/search?q={N}");',
)

_PLACEHOLDER = re.compile(r"\{(KU|PU|K|P|N|M|O)(?::(\d+):(\d+))?\}")


def _token(col: str):
    return F.translate(F.md5(F.col(col)), "0123456789", "ghijklmnop")


def render_template(template: str, host_col: str = "host", url_col: str = "page_url",
                    id_col: str = "page_id"):
    """Spark column for a snippet template (see placeholders above)."""
    parts, pos = [], 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name = m.group(1)
        expr = {"K": _token(host_col), "KU": F.upper(_token(host_col)),
                "P": _token(url_col), "PU": F.upper(_token(url_col)),
                "N": F.col(id_col).cast("string"),
                "M": F.pmod(F.col(id_col), F.lit(250)).cast("string"),
                "O": F.split_part(F.col(host_col), F.lit("."), F.lit(1))}[name]
        if m.group(2):
            expr = F.substring(expr, int(m.group(2)), int(m.group(3)))
        parts.append(expr)
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def js_corpus(spark, d, load=load) -> DataFrame:
    """(url, content): a script per page at <authority>/static/js/app-<page_id>.js whose
    text is the whole page HTML followed by the seeded snippets."""
    p = load(spark, d, "pages").select("page_id", F.col("url").alias("page_url"), "html",
                               url_host("url").alias("host"))
    snippets = F.concat_ws("\n", *[render_template(t) for t in SEED_SNIPPETS])
    url = F.concat(url_scheme("page_url"), F.lit("://"), url_authority("page_url"),
                   F.lit("/static/js/app-"), F.col("page_id").cast("string"), F.lit(".js"))
    return p.select(url.alias("url"),
                    F.concat(F.col("html"), F.lit("\n<script>\n"), snippets,
                             F.lit("\n</script>\n")).alias("content"))


def document_corpus(spark, d, load=load) -> DataFrame:
    """(url, content) for ``documents``: url = doc://<source>/<doc_id>."""
    return load(spark, d, "documents").select(
        F.concat(F.lit("doc://"), F.col("source"), F.lit("/"),
                 F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("content"))


def turn_corpus(spark, d, load=load) -> DataFrame:
    """(url, content) for ``conversations``: url = conv://<conv_id>/<turn>."""
    return load(spark, d, "conversations").select(
        F.concat(F.lit("conv://"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")).alias("url"),
        F.col("text").alias("content"))


def secret_corpus(spark, d, load=load) -> DataFrame:
    """Scripts derived from pages, the documents and the conversation turns: the leak-scan
    corpus. ``load`` reads the tables, or streams them."""
    parts = (js_corpus, document_corpus, turn_corpus)
    first, *rest = (part(spark, d, load) for part in parts)
    return reduce(DataFrame.unionByName, rest, first)


def robots_docs(spark, d) -> DataFrame:
    """(host, kind, text): a robots.txt and a sitemap per page, derived from the page URL and
    its links (one document per page: never a whole host gathered into one row)."""
    p = pages(spark, d).select("page_id", "url", "html", url_host("url").alias("host"))
    base = F.concat(url_scheme("url"), F.lit("://"), url_authority("url"))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    robots = F.concat_ws("\n", F.lit("User-agent: *"), F.concat(F.lit("Disallow: "), path),
                         F.lit("Allow: /"), F.lit("# comment line"),
                         F.concat(F.lit("Sitemap: "), base, F.lit("/sitemap.xml")))
    locs = F.transform(F.regexp_extract_all("html", F.lit(r'href="(/[^"]*)"'), 1),
                       lambda x: F.concat(F.lit("<url><loc>"), base, x, F.lit("</loc></url>")))
    sitemap = F.concat_ws("\n", F.concat(F.array(F.lit("<urlset>")), locs))
    return (p.select("host", F.lit("robots").alias("kind"), robots.alias("text"))
            .unionByName(p.select("host", F.lit("sitemap").alias("kind"), sitemap.alias("text"))))


def humans_docs(spark, d) -> DataFrame:
    """(host, kind, text): a humans.txt per page, from its URL; some have no first heading, some an open last one."""
    p = pages(spark, d).select("page_id", url_host("url").alias("host"), url_scheme("url").alias("scheme"))
    n = F.col("page_id").cast("string")
    text = F.concat_ws("\n", F.when(F.col("page_id") % 3 > 0, F.lit("/* Team */")), F.concat(F.lit("Editor: person "), n),
                       F.concat(F.lit("\t Contact :  desk@"), F.col("host"), F.lit("  ")), F.lit("no field here"), F.lit(" : no label"),
                       F.lit("/* SITE */"), F.concat(F.lit("Address: "), F.col("scheme"), F.lit("://"), F.col("host")), F.lit("Doctype:"),
                       F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("/* THANKS\nReaders: "), n)))
    return p.select("host", F.lit("humans").alias("kind"), text.alias("text"))
