"""Registered queries: hosts, DNS, network, names (SRC6, JN11, ARR1-ARR3, FLT1, FLT2, JN12,
PRJ1-PRJ3, PRJ5, PRJ6, PRJ8, PRJ9, FLT16, JN8-JN10, WIN3, SET2, SET4, SNK2, JN5, JN6, CLS5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from surfacekit.functions import text as TX
from surfacekit.functions import urls as U
from surfacekit.operators import endpoints as EP
from surfacekit.operators import filters as FL
from surfacekit.operators import inventory as INV
from surfacekit.operators import run_history as RH
from surfacekit.operators.classify import storage_exposure
from surfacekit.operators.links import page_links
from surfacekit.plans import sqlbits as S
from surfacekit.plans import sqlfind as SF
from surfacekit.plans import sqlinfra as SI
from surfacekit.plans.endpoint_queries import _cloud_sql
from surfacekit.plans.registry import register
from surfacekit.plans.secret_queries import corpus_cte
from surfacekit.sources import findings as FD
from surfacekit.sources import infra as I
from surfacekit.sources import tables as T
from surfacekit.sources.ledger import Ledger
from surfacekit.streaming.findings_stream import job_dir


def _dns(spark, d):
    return INV.parse_dns_answers(I.dns_answer_lines(spark, d))


@register("src6_parse_dns_answers", S.with_(SI.DNS) + "SELECT name, ttl, rtype, value FROM dns_records")
def q_src6(spark, d):
    return _dns(spark, d)


_SEL = ", ".join(S.lit(s) for s in I.DKIM_SELECTORS)
_DK = r"^([^.]+)\._domainkey\.(.+)$"


@register("jn11_mail_auth_audit", S.with_(SI.DNS) + f""",
spf AS (SELECT DISTINCT name AS domain FROM dns_records WHERE rtype = 'TXT' AND contains(lower(value), 'v=spf')),
dmarc AS (SELECT DISTINCT substr(name, 8) AS domain FROM dns_records WHERE rtype = 'TXT' AND starts_with(name, '_dmarc.')),
dk AS (
  SELECT regexp_extract(name, {S.lit(_DK)}, 2) AS domain, count(DISTINCT regexp_extract(name, {S.lit(_DK)}, 1)) AS n
  FROM dns_records WHERE rtype = 'TXT' AND regexp_extract(name, {S.lit(_DK)}, 1) IN ({_SEL}) GROUP BY 1
)
SELECT h.host AS domain, spf.domain IS NOT NULL AS has_spf, dmarc.domain IS NOT NULL AS has_dmarc,
  CAST(coalesce(dk.n, 0) AS BIGINT) AS dkim_selectors,
  concat_ws(',', CASE WHEN spf.domain IS NULL THEN 'spf' END, CASE WHEN dmarc.domain IS NULL THEN 'dmarc' END) AS missing
FROM host_facts h LEFT JOIN spf ON spf.domain = h.host LEFT JOIN dmarc ON dmarc.domain = h.host
LEFT JOIN dk ON dk.domain = h.host""")
def q_jn11(spark, d):
    domains = I.host_facts(spark, d).select(F.col("host").alias("domain"))
    return INV.mail_auth_audit(domains, _dns(spark, d), I.DKIM_SELECTORS)


_CT_NAMES = f"""
ct_lines AS (SELECT unnest(string_split(name_value, chr(10))) AS raw FROM ct_entries),
ct_names AS (SELECT DISTINCT {SI.normalize('raw')} AS host FROM ct_lines WHERE {SI.normalize('raw')} <> '')"""


@register("arr1_explode_ct_names", S.with_(SI.CT, _CT_NAMES) + f"""
SELECT host FROM ct_names WHERE {SI.in_scope('host')}""")
def q_arr1(spark, d):
    return INV.explode_ct_names(I.ct_entries(spark, d), I.scope_domains(spark, d))


@register("arr2_explode_sans", S.with_(SI.NETWORK) + """
SELECT DISTINCT host, lower(trim(s)) AS san FROM (SELECT host, unnest(san) AS s FROM tls)
WHERE lower(trim(s)) <> ''""")
def q_arr2(spark, d):
    return INV.explode_sans(I.tls(spark, d))


@register("arr3_flatten_passive", S.with_(SI.HOST_FACTS) + f""",
pp AS (SELECT p.url, {S.host('p.url')} AS host FROM pages p),
pj AS (SELECT pp.url, pp.host, f.ip FROM pp LEFT JOIN host_facts f USING (host))
SELECT 'url' AS kind, url AS value FROM pj WHERE url <> ''
UNION ALL SELECT 'subdomain', host FROM pj
UNION ALL SELECT 'subdomain', 'www.' || host FROM pj
UNION ALL SELECT 'scan', url || ' | ' || coalesce(ip, '') || ' | ' FROM pj""")
def q_arr3(spark, d):
    return INV.flatten_passive(I.passive_docs(spark, d))


_CANDS = f"""
cand_hosts AS (
  SELECT host FROM ct_names
  UNION SELECT {S.host('url')} FROM pages
  UNION SELECT lower(trim(s)) FROM (SELECT unnest(san) AS s FROM tls) WHERE trim(s) <> ''
)"""


def _cand_hosts(spark, d):
    ct = I.ct_entries(spark, d).select(F.explode(F.split("name_value", "\n")).alias("raw"))
    ct = ct.select(U.normalize_target("raw").alias("host")).where(F.col("host") != "")
    pages = T.pages(spark, d).select(U.url_host("url").alias("host"))
    sans = INV.explode_sans(I.tls(spark, d)).select(F.col("san").alias("host"))
    return ct.unionByName(pages).unionByName(sans).distinct()


@register("flt1_valid_hostnames", S.with_(SI.NETWORK, SI.CT, _CT_NAMES, _CANDS) + f"""
SELECT host FROM cand_hosts WHERE regexp_matches(host, {S.lit('^' + FL.LABEL + '(\\.' + FL.LABEL + ')*$')})""")
def q_flt1(spark, d):
    return FL.valid_hostnames(_cand_hosts(spark, d))


@register("flt2_in_scope", S.with_(SI.NETWORK, SI.CT, _CT_NAMES, _CANDS) + f"""
SELECT host FROM cand_hosts WHERE {SI.in_scope('host')}""")
def q_flt2(spark, d):
    return FL.in_scope(_cand_hosts(spark, d), "host", I.scope_domains(spark, d))


@register("jn12_scope_join", S.with_(SI.NETWORK, SI.CT, _CT_NAMES, _CANDS) + f"""
SELECT host, {SI.in_scope('host')} AS in_scope FROM cand_hosts""")
def q_jn12(spark, d):
    c, scope = _cand_hosts(spark, d), I.scope_domains(spark, d)
    return (FL.in_scope(c, "host", scope).withColumn("in_scope", F.lit(True))
            .unionByName(FL.in_scope(c, "host", scope, keep=False).withColumn("in_scope", F.lit(False))))


@register("prj1_normalize_target", S.with_(SI.CT) + f""",
ct_lines AS (SELECT unnest(string_split(name_value, chr(10))) AS raw FROM ct_entries)
SELECT DISTINCT raw, {SI.normalize('raw')} AS target, starts_with(trim(raw), '*.') AS wildcard FROM ct_lines""")
def q_prj1(spark, d):
    lines = I.ct_entries(spark, d).select(F.explode(F.split("name_value", "\n")).alias("raw"))
    return lines.select("raw", U.normalize_target("raw").alias("target"),
                        U.is_wildcard("raw").alias("wildcard")).distinct()


@register("prj2_org_and_parts", S.with_(SI.HOST_FACTS) + f"""
SELECT host, split_part({SI.normalize('host')}, '.', 1) AS org,
  array_to_string(string_split(translate({SI.normalize('host')}, '-_', '..'), '.'), ',') AS parts
FROM page_hosts""")
def q_prj2(spark, d):
    h = I.host_facts(spark, d).select("host")
    return h.select("host", U.org_name("host").alias("org"),
                    F.array_join(U.name_parts("host"), ",").alias("parts"))


@register("prj3_extract_http_urls", S.with_(corpus_cte()) + f"""
SELECT DISTINCT unnest(regexp_extract_all(content, {S.lit(TX.HTTP_URL)})) AS url FROM js_corpus""")
def q_prj3(spark, d):
    return (T.js_corpus(spark, d).select(F.explode(TX.extract_http_urls("content")).alias("url"))
            .distinct())


_URLS = S.url_sources_cte()


@register("prj5_query_params", S.with_(_URLS) + f"""
SELECT param, count(DISTINCT url) AS urls, min(url) AS example FROM (
  SELECT url, split_part(kv, '=', 1) AS param FROM (
    SELECT url, unnest(string_split({S.query('url')}, '&')) AS kv FROM url_corpus))
WHERE param <> '' GROUP BY param""")
def q_prj5(spark, d):
    return INV.query_params(T.url_corpus(spark, d))


def _url_key_sql(u: str) -> str:
    q = S.query(u)
    return (f"(regexp_replace({S.host(u)}, '^www\\.', '') || CASE WHEN {S.port(u)} <> '' THEN ':' || {S.port(u)} ELSE '' END"
            f" || {S.path(u)} || CASE WHEN {q} <> '' THEN '?' || array_to_string(list_sort(string_split({q}, '&')), '&') ELSE '' END)")


@register("prj6_url_key", S.with_(_URLS) + f"""
SELECT url_key, min(url) AS url FROM (SELECT {_url_key_sql('url')} AS url_key, url FROM url_corpus) GROUP BY url_key""")
def q_prj6(spark, d):
    return INV.collapse_urls(T.url_corpus(spark, d))


@register("prj8_safe_name", S.with_(_URLS) + """
SELECT url, regexp_replace(regexp_replace(url, '://', '_', 'g'), '[/:]', '_', 'g') AS safe_name,
  substr(md5(url), 1, 8) AS hash8, substr(md5(url), 1, 12) AS hash12 FROM url_corpus""")
def q_prj8(spark, d):
    u = T.url_corpus(spark, d)
    return u.select("url", U.safe_name("url").alias("safe_name"), U.short_hash("url", 8).alias("hash8"),
                    U.short_hash("url", 12).alias("hash12"))


@register("prj9_extract_ipv4", f"""
SELECT DISTINCT ip FROM (SELECT unnest(regexp_extract_all(text, '[0-9]+(\\.[0-9]+)*')) AS ip FROM documents)
WHERE regexp_matches(ip, {S.lit(TX.IPV4_ANCHORED)})""")
def q_prj9(spark, d):
    return (T.load(spark, d, "documents").select(F.explode(TX.extract_ipv4("text")).alias("ip"))
            .distinct())


@register("flt16_is_ipv4", f"""
SELECT DISTINCT c AS candidate, regexp_matches(c, {S.lit(TX.IPV4_ANCHORED)}) AS is_ipv4 FROM (
  SELECT unnest(regexp_extract_all(text, '[0-9]+(\\.[0-9]+)*')) AS c FROM documents)
WHERE length(c) - length(replace(c, '.', '')) = 3""")
def q_flt16(spark, d):
    c = T.load(spark, d, "documents").select(
        F.explode(TX.dotted_groups("text")).alias("candidate"))
    c = c.where(F.length("candidate") - F.length(F.replace("candidate", F.lit("."), F.lit(""))) == 3)
    return c.select("candidate", TX.is_ipv4("candidate").alias("is_ipv4")).distinct()


@register("jn8_ip_to_network", S.with_(SI.NETWORK) + f""",
r AS (
  SELECT cidr, asn, bits, base - base % size AS lo, base - base % size + size - 1 AS hi FROM (
    SELECT cidr, asn, CAST(split_part(cidr, '/', 2) AS INTEGER) AS bits,
      {SI.ip_long("split_part(cidr, '/', 1)")} AS base,
      CAST(1 AS BIGINT) << (32 - CAST(split_part(cidr, '/', 2) AS INTEGER)) AS size
    FROM asn_ranges)
),
i AS (SELECT DISTINCT ip, {SI.ip_long('ip')} AS n FROM host_facts)
SELECT ip, cidr, asn, bits AS prefix FROM (
  SELECT i.ip, r.cidr, r.asn, r.bits, row_number() OVER (PARTITION BY i.ip ORDER BY r.bits DESC) AS rn
  FROM i JOIN r ON i.n BETWEEN r.lo AND r.hi) WHERE rn = 1""")
def q_jn8(spark, d):
    return INV.ip_to_network(I.host_facts(spark, d), I.asn_ranges(spark))


@register("jn8_address_to_network", S.with_(SI.NETWORK) + f""",
r(cidr, lo, hi) AS (VALUES
  ('10.0.0.0/8', '0a000000', '0affffff'), ('10.0.0.0/10', '0a000000', '0a3fffff'),
  ('10.16.0.0/12', '0a100000', '0a1fffff'), ('10.32.0.0/11', '0a200000', '0a3fffff'),
  ('203.0.113.0/24', 'cb007100', 'cb0071ff'), ('198.51.100.0/24', 'c6336400', 'c63364ff'),
  ('2001:db8::/32', '20010db8' || repeat('0', 24), '20010db8' || repeat('f', 24)),
  ('2001:DB8:8000::/33', '20010db88000' || repeat('0', 20), '20010db8ffff' || repeat('f', 20)),
  ('2001:db8:0:0::/64', '20010db8' || repeat('0', 24), '20010db800000000' || repeat('f', 16)),
  ('fd00::1/8', 'fd' || repeat('0', 30), 'fd' || repeat('f', 30)),
  ('fd00:4000::/18', 'fd004000' || repeat('0', 24), 'fd007fff' || repeat('f', 24))),
a AS (SELECT md5(host) AS m, ip, printf('%08x', {SI.ip_long('ip')}) AS four,
        CAST('0x' || substr(md5(host), 23, 2) AS INTEGER) % 4 AS form FROM host_facts),
i AS (SELECT DISTINCT ip, four AS n FROM a UNION SELECT CASE form
    WHEN 0 THEN upper('2001:db8:' || m[1:4] || ':' || m[5:8] || ':' || m[9:12] || ':' || m[13:16] || ':' || m[17:20] || ':' || m[21:24])
    WHEN 1 THEN '2001:db8::' || m[1:4] WHEN 2 THEN 'fd00:' || m[1:4] || '::' || m[5:8] || ':' || m[9:12]
    ELSE '::ffff:' || ip END,
  CASE form WHEN 0 THEN '20010db8' || m[1:24] WHEN 1 THEN '20010db8' || repeat('0', 20) || m[1:4]
    WHEN 2 THEN 'fd00' || m[1:4] || repeat('0', 16) || m[5:12] ELSE four END FROM a)
SELECT ip, cidr, asn, prefix FROM (
  SELECT i.ip, r.cidr, v.asn, CAST(split_part(r.cidr, '/', 2) AS INTEGER) AS prefix,
    row_number() OVER (PARTITION BY i.ip ORDER BY CAST(split_part(r.cidr, '/', 2) AS INTEGER) DESC) AS rn
  FROM i JOIN r ON length(i.n) = length(r.lo) AND i.n BETWEEN r.lo AND r.hi
  JOIN (VALUES {", ".join(f"({S.lit(c)}, {S.lit(a)})" for c, a in I.ASN_RANGES + I.ASN_RANGES_V6)}) v(cidr, asn) ON v.cidr = r.cidr)
WHERE rn = 1""")
def q_jn8_both(spark, d):
    answers = INV.parse_dns_answers(I.address_lines(spark, d)).where("rtype in ('A', 'AAAA')")
    return INV.ip_to_network(answers, I.asn_ranges_both(spark), "value")


@register("jn9_reverse_dns", S.with_(SI.NETWORK) + """
SELECT i.ip, p.name FROM (SELECT DISTINCT ip FROM host_facts) i LEFT JOIN ptr p USING (ip)""")
def q_jn9(spark, d):
    return INV.reverse_dns(I.host_facts(spark, d), I.ptr(spark, d))


@register("jn10_service_inventory", S.with_(SI.NETWORK) + """
SELECT h.host, p.ip, p.port, s.service, s.version FROM page_hosts h
LEFT JOIN ports p USING (host) LEFT JOIN services s ON s.ip = p.ip AND s.port = p.port""")
def q_jn10(spark, d):
    return INV.service_inventory(I.host_facts(spark, d), I.ports(spark, d), I.services(spark, d))


_HOST_SOURCES = f"""
src_hosts AS (
  SELECT {S.host('url')} AS host, 'pages' AS source, 1 AS source_rank FROM pages
  UNION ALL SELECT {S.host('url')}, 'links', 2 FROM page_links
  UNION ALL SELECT host, 'ct', 3 FROM ct_names WHERE {SI.in_scope('host')}
  UNION ALL SELECT lower(trim(s)), 'san', 4 FROM (SELECT unnest(san) AS s FROM tls) WHERE trim(s) <> ''
)"""


def _host_sources(spark, d):
    p = T.pages(spark, d)
    pages = p.select(U.url_host("url").alias("host"), F.lit("pages").alias("source"),
                     F.lit(1).alias("source_rank"))
    links = page_links(p).select(U.url_host("url").alias("host"), F.lit("links").alias("source"),
                                 F.lit(2).alias("source_rank"))
    ct = INV.explode_ct_names(I.ct_entries(spark, d), I.scope_domains(spark, d)).select(
        "host", F.lit("ct").alias("source"), F.lit(3).alias("source_rank"))
    san = INV.explode_sans(I.tls(spark, d)).select(F.col("san").alias("host"), F.lit("san").alias("source"),
                                                   F.lit(4).alias("source_rank"))
    return pages.unionByName(links).unionByName(ct).unionByName(san)


_HS = S.with_(S.PAGE_LINKS, SI.NETWORK, SI.CT, _CT_NAMES, _HOST_SOURCES)


@register("win3_source_contribution", _HS + """,
first AS (SELECT host, min(source_rank) AS first_rank FROM src_hosts GROUP BY host),
per AS (SELECT DISTINCT host, source, source_rank FROM src_hosts)
SELECT source, source_rank, count(*) AS hosts, CAST(sum(CASE WHEN source_rank = first_rank THEN 1 ELSE 0 END) AS BIGINT) AS new_unique
FROM per JOIN first USING (host) GROUP BY source, source_rank""")
def q_win3(spark, d):
    return INV.source_contribution(_host_sources(spark, d))


@register("set2_difference", _HS + """
SELECT DISTINCT host FROM src_hosts WHERE source IN ('ct', 'san')
  AND host NOT IN (SELECT host FROM src_hosts WHERE source = 'pages')""")
def q_set2(spark, d):
    h = _host_sources(spark, d)
    new = h.where(F.col("source").isin("ct", "san")).select("host").distinct()
    return INV.difference(new, h.where(F.col("source") == "pages"), ["host"])


@register("set4_asset_diff", _HS + """,
prev AS (SELECT DISTINCT host FROM src_hosts WHERE source IN ('pages', 'links')),
curr AS (SELECT DISTINCT host FROM src_hosts WHERE source IN ('ct', 'san'))
SELECT coalesce(prev.host, curr.host) AS host,
  CASE WHEN prev.host IS NULL THEN 'added' WHEN curr.host IS NULL THEN 'removed' ELSE 'kept' END AS status
FROM prev FULL OUTER JOIN curr ON prev.host = curr.host""")
def q_set4(spark, d):
    h = _host_sources(spark, d)
    return INV.asset_diff(h.where(F.col("source").isin("pages", "links")),
                          h.where(F.col("source").isin("ct", "san")))


_SIGHT = """
sightings AS (SELECT DISTINCT {host} AS asset, CAST(ts AS DATE) - DATE '2024-01-01' + 1 AS run FROM findings WHERE starts_with(url, 'http')),
last AS (SELECT max(run) AS n FROM sightings)""".format(host=S.host("url"))
_HISTORY = S.with_(S.seed_urls_cte(), SF.FINDINGS, _SIGHT)


def _run_history(spark, d):
    """Hosts that the findings of each day name: a run is a day, numbered from the first day of the
    event tables on."""
    f = FD.findings(spark, d).where(F.col("url").startswith("http"))
    run = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) + 1
    seen = f.select(U.url_host("url").alias("asset"), run.alias("run")).distinct()
    return RH.history_of(seen, last_run=seen.agg(F.max("run")).scalar())


@register("set4_run_history", _HISTORY + """
SELECT asset, min(run) AS since, CASE WHEN max(run) < any_value(n) THEN max(run) + 1 END AS until FROM (
  SELECT asset, run, run - row_number() OVER (PARTITION BY asset ORDER BY run) AS island FROM sightings) , last GROUP BY asset, island""")
def q_set4_history(spark, d):
    """The validity intervals of all assets over all runs."""
    return _run_history(spark, d)


@register("set4_run_diff", _HISTORY + """,
a AS (SELECT asset FROM sightings WHERE run = 10), b AS (SELECT asset FROM sightings WHERE run = 20)
SELECT coalesce(a.asset, b.asset) AS asset, CASE WHEN a.asset IS NULL THEN 'added' WHEN b.asset IS NULL THEN 'removed' ELSE 'kept' END AS status
FROM a FULL OUTER JOIN b ON a.asset = b.asset""")
def q_set4_diff(spark, d):
    """Runs 10 and 20 compared from the intervals, without the runs between."""
    return RH.diff_runs(_run_history(spark, d), 10, 20)


@register("snk2_append_new", S.with_(SI.CT) + f""",
ct_lines AS (SELECT {SI.normalize('unnest(string_split(name_value, chr(10)))')} AS host FROM ct_entries)
SELECT host, min(batch) AS batch FROM (
  SELECT {S.host('url')} AS host, 'pages' AS batch, 1 AS k FROM pages
  UNION ALL SELECT host, 'zct', 2 FROM ct_lines WHERE host <> '') GROUP BY host""")
def q_snk2(spark, d):
    """Two appends to one sink: the page hosts, then the certificate names that it lacks. Both are named,
    so calling the query again appends nothing."""
    sink = Ledger(spark, f"{job_dir(spark, 'snk2-hosts', d)}/sink")
    pages = T.pages(spark, d).select(U.url_host("url").alias("host"), F.lit("pages").alias("batch"))
    names = (I.ct_entries(spark, d).select(F.explode(F.split("name_value", "\n")).alias("raw"))
             .select(U.normalize_target("raw").alias("host"), F.lit("zct").alias("batch")).where(F.col("host") != ""))
    for name, rows in (("pages", pages), ("zct", names)):
        sink.append_new(rows, "host", name=name)
    return sink.read()


def _variants_sql() -> str:
    pre = "[" + ", ".join(S.lit(x) for x in INV.BUCKET_PREFIXES) + "]"
    suf = "[" + ", ".join(S.lit(x) for x in INV.BUCKET_SUFFIXES) + "]"
    acc = "[" + ", ".join(S.lit(x) for x in INV.ACCOUNT_SUFFIXES) + "]"
    rt = "[" + ", ".join(S.lit(x) for x in INV.REALTIME_DB_SUFFIXES) + "]"
    return f"""
targets AS (SELECT DISTINCT {SI.normalize(S.host('url'))} AS t FROM pages),
t2 AS (SELECT split_part(t, '.', 1) AS org, string_split(translate(t, '-_', '..'), '.') AS parts FROM targets),
bases AS (SELECT DISTINCT org, unnest(list_concat([org], parts[1:2])) AS base FROM t2),
variants AS (
  SELECT DISTINCT kind, name FROM (
    SELECT 'bucket' AS kind, regexp_replace(lower(pre || base || suf), '[^a-z0-9.-]', '-', 'g') AS name
    FROM bases, (SELECT unnest({pre}) AS pre), (SELECT unnest({suf}) AS suf)
    UNION ALL
    SELECT 'account', substr(regexp_replace(lower(base || suf), '[^a-z0-9]', '', 'g'), 1, 24)
    FROM bases, (SELECT unnest({acc}) AS suf)
    UNION ALL
    SELECT 'realtime_db', unnest(list_concat([org], list_transform({rt}, lambda s: org || '-' || s)))
    FROM (SELECT DISTINCT org FROM bases))
  WHERE (kind = 'bucket' AND length(name) BETWEEN 3 AND 63)
     OR (kind = 'account' AND length(name) BETWEEN 3 AND 24) OR kind = 'realtime_db'
)"""


@register("jn5_name_variants", S.with_(_variants_sql()) + "SELECT kind, name FROM variants")
def q_jn5(spark, d):
    targets = T.pages(spark, d).select(U.url_host("url").alias("target")).distinct()
    return INV.name_variants(targets)


def _obs_sql() -> str:
    name = ("CASE WHEN provider = 's3' THEN coalesce(nullif(regexp_extract(ref, '(?i)^s3://([a-z0-9._-]+)', 1), ''),"
            " regexp_extract(ref, '(?i)^([a-z0-9.-]+)\\.s3\\.amazonaws\\.com', 1))"
            " WHEN provider = 'firebase' THEN regexp_extract(ref, '^([a-z0-9-]+)\\.', 1)"
            " WHEN provider = 'gcs' THEN regexp_extract(ref, 'googleapis\\.com/([a-z0-9._-]+)', 1)"
            " ELSE regexp_extract(ref, '^([a-z0-9]+)\\.', 1) END")
    return f"""
obs0 AS (SELECT DISTINCT provider AS p0, ref, {name} AS name FROM refs),
obs AS (
  SELECT CASE WHEN p0 = 'firebase' THEN 'firebase-db' ELSE p0 END AS provider, name, ref AS url,
    [200, 403, 301, 404][{SI.hb('name', 0)} % 4 + 1] AS status,
    CASE WHEN p0 = 'firebase' THEN CASE WHEN {SI.hb('name', 0)} % 2 = 0 THEN '{{"users":{{}}}}'
         ELSE '{{"error":"Permission denied"}}' END ELSE '' END AS body
  FROM obs0 WHERE name <> ''
),
obs_class AS (
  SELECT *, CASE
    WHEN provider = 's3' THEN CASE status WHEN 200 THEN 'open' WHEN 403 THEN 'exists-private' WHEN 301 THEN 'redirect' END
    WHEN provider = 'azure' THEN CASE WHEN status = 200 THEN 'open' WHEN status IN (400, 403, 409) THEN 'exists' END
    WHEN provider = 'gcs' THEN CASE WHEN status IN (200, 403) THEN 'exists' END
    WHEN provider = 'firebase-storage' THEN CASE WHEN status IN (200, 403) THEN 'exists' END
    WHEN provider = 'firebase-db' THEN CASE WHEN coalesce(body, '') <> '' AND NOT contains(substr(lower(coalesce(body, '')), 1, 50), 'error') THEN 'open' END
  END AS exposure FROM obs
)"""


def _observations(spark, d):
    texts = (T.url_corpus(spark, d).select(F.col("url").alias("text"))
             .unionByName(T.js_corpus(spark, d).select(F.col("content").alias("text"))))
    return INV.storage_observations(EP.cloud_references(texts)).distinct()


_OBS = S.with_(S.url_sources_cte(), corpus_cte(), _cloud_sql(), _obs_sql())


@register("cls5_storage_exposure", _OBS + "SELECT provider, name, url, status, exposure FROM obs_class")
def q_cls5(spark, d):
    return storage_exposure(_observations(spark, d)).select("provider", "name", "url", "status", "exposure")


@register("jn6_match_inventory", S.with_(S.url_sources_cte(), corpus_cte(), _cloud_sql(), _obs_sql(),
                                         _variants_sql()) + """
SELECT o.provider, o.name, o.url, o.status, o.exposure FROM obs_class o
WHERE o.name IN (SELECT name FROM variants)""")
def q_jn6(spark, d):
    targets = T.pages(spark, d).select(U.url_host("url").alias("target")).distinct()
    return INV.match_inventory(INV.name_variants(targets), _observations(spark, d)).select(
        "provider", "name", "url", "status", "exposure")
