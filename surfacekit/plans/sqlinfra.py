"""DuckDB CTEs for the host / DNS / network tables (see sources/infra.py)."""

from __future__ import annotations

from surfacekit.operators import inventory as INV
from surfacekit.plans import sqlbits as S
from surfacekit.sources import infra as I


def hb(col: str, i: int) -> str:
    return f"CAST(('0x' || substr(md5({col}), {2 * i + 1}, 2)) AS INTEGER)"


def registrable(col: str) -> str:
    return f"regexp_extract({col}, '([^.]+\\.[^.]+)$', 1)"


def _sels() -> str:
    return "[" + ", ".join(S.lit(s) for s in I.DKIM_SELECTORS) + "]"


HOST_FACTS = f"""
page_hosts AS (SELECT DISTINCT {S.host('url')} AS host FROM pages),
host_facts AS (
  SELECT host, {registrable('host')} AS domain,
    CASE WHEN {hb('host', 0)} % 4 = 0 THEN '203.0.113.' || CAST({hb('host', 3)} % 254 + 1 AS VARCHAR)
         ELSE '10.' || CAST({hb('host', 1)} % 64 AS VARCHAR) || '.' || CAST({hb('host', 2)} AS VARCHAR)
              || '.' || CAST({hb('host', 3)} % 254 + 1 AS VARCHAR) END AS ip,
    {hb('host', 4)} % 3 <> 0 AS spf, {hb('host', 5)} % 2 = 0 AS dmarc,
    CASE WHEN {hb('host', 6)} % 3 = 0 THEN {_sels()}[{hb('host', 6)} % 8 + 1] END AS dkim,
    CASE WHEN {hb('host', 8)} % 5 = 0 THEN CAST([] AS INTEGER[])
         ELSE list_filter([80, 443, CASE WHEN {hb('host', 7)} % 2 = 0 THEN 8080 END,
                           CASE WHEN {hb('host', 7)} % 3 = 0 THEN 22 END,
                           CASE WHEN {hb('host', 7)} % 5 = 0 THEN 3306 END], lambda x: x IS NOT NULL) END AS ports,
    {hb('host', 9)} % 3 <> 0 AS has_ptr,
    'v' || CAST({hb('host', 10)} % 5 AS VARCHAR) AS version
  FROM page_hosts
)"""

DNS = f"""{HOST_FACTS},
dns_lines AS (
  SELECT unnest(list_filter([
    ';; ANSWER SECTION ' || host,
    host || '. 300 IN A ' || ip,
    host || '. 3600 IN MX 10 mail.' || domain || '.',
    host || '. 86400 IN NS ns1.' || domain || '.',
    CASE WHEN spf THEN host || '. 300 IN TXT "v=spf1 include:_spf.' || domain || ' ~all"' END,
    CASE WHEN dmarc THEN '_dmarc.' || host || '. 300 IN TXT "v=DMARC1; p=none"' END,
    CASE WHEN dkim IS NOT NULL THEN dkim || '._domainkey.' || host || '. 300 IN TXT "v=DKIM1; k=rsa"' END,
    'www.' || host || '. 300 IN CNAME ' || host || '.',
    'garbage line without a record'], lambda x: x IS NOT NULL)) AS line
  FROM host_facts
),
dns_parsed AS (
  SELECT regexp_extract(trim(line), {S.lit(INV._DNS_LINE)}, 1) AS name,
         regexp_extract(trim(line), {S.lit(INV._DNS_LINE)}, 2) AS ttl,
         regexp_extract(trim(line), {S.lit(INV._DNS_LINE)}, 3) AS rtype,
         regexp_extract(trim(line), {S.lit(INV._DNS_LINE)}, 4) AS value
  FROM dns_lines
),
dns_records AS (
  SELECT lower(name) AS name, CAST(ttl AS INTEGER) AS ttl, rtype,
         regexp_replace(value, '^"|"$', '', 'g') AS value
  FROM dns_parsed WHERE rtype <> ''
)"""

NETWORK = f"""{HOST_FACTS},
ports AS (SELECT host, ip, unnest(ports) AS port FROM host_facts),
services AS (
  SELECT DISTINCT p.ip, p.port,
    CASE p.port WHEN 80 THEN 'http' WHEN 443 THEN 'https' WHEN 22 THEN 'ssh' WHEN 3306 THEN 'mysql' END AS service,
    f.version
  FROM ports p JOIN host_facts f USING (host) WHERE p.port IN (80, 443, 22, 3306)
),
ptr AS (
  SELECT DISTINCT ip, 'host-' || replace(ip, '.', '-') || '.static.example.net' AS name
  FROM host_facts WHERE has_ptr
),
tls AS (
  SELECT host, host AS cn, [host, 'www.' || host, 'api.' || domain, ''] AS san
  FROM host_facts WHERE list_contains(ports, 443)
),
asn_ranges(cidr, asn) AS (VALUES {", ".join(f"({S.lit(c)}, {S.lit(a)})" for c, a in I.ASN_RANGES)})"""

CT = f"""
ct_entries AS (
  SELECT concat_ws(chr(10), host, '*.' || host, upper(host), 'www.' || host, host || '.mirror.invalid',
                   ' ' || {registrable('host')} || ' ', 'admin@' || {registrable('host')}) AS name_value
  FROM (SELECT {S.host('url')} AS host FROM pages)
),
scope_domains AS (SELECT DISTINCT {registrable(S.host('url'))} AS domain FROM pages)"""


def normalize(col: str) -> str:
    return f"regexp_replace(lower(trim({col})), '^[*.]+', '')"


def in_scope(col: str) -> str:
    return (f"EXISTS (SELECT 1 FROM scope_domains s WHERE lower({col}) = s.domain "
            f"OR ends_with(lower({col}), '.' || s.domain))")


def ip_long(col: str) -> str:
    return (f"(CAST(split_part({col}, '.', 1) AS BIGINT) * 16777216 + CAST(split_part({col}, '.', 2) AS BIGINT) * 65536"
            f" + CAST(split_part({col}, '.', 3) AS BIGINT) * 256 + CAST(split_part({col}, '.', 4) AS BIGINT))")
