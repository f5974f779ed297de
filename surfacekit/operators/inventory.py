"""Host / URL inventory, DNS, network and naming operators.

SRC6, ARR1-ARR3, WIN3, SET2, SET4, SNK2 (logic), JN2, JN5, JN6, JN8-JN11, PRJ5, PRJ6.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surfacekit.functions.addresses import address_key, network_bits
from surfacekit.functions.text import display_passive
from surfacekit.functions.urls import normalize_target, url_key, url_query
from surfacekit.operators.filters import in_scope

# --------------------------------------------------------------------------- DNS
DNS_TYPES = ("A", "AAAA", "MX", "NS", "TXT", "CNAME", "SOA", "CAA")
_DNS_LINE = (r"^([^ \t;]+?)\.?[ \t]+([0-9]+)[ \t]+IN[ \t]+(" + "|".join(DNS_TYPES)
             + r")[ \t]+(.*)$")


def parse_dns_answers(lines: DataFrame, col: str = "line") -> DataFrame:
    """SRC6 (re-aimed): answer lines -> dns_records(name, ttl, rtype, value); headings and
    junk are dropped; TXT values lose their quotes."""
    c = F.trim(F.col(col))
    rec = lines.select(F.regexp_extract(c, _DNS_LINE, 1).alias("name"),
                       F.regexp_extract(c, _DNS_LINE, 2).alias("ttl"),
                       F.regexp_extract(c, _DNS_LINE, 3).alias("rtype"),
                       F.regexp_extract(c, _DNS_LINE, 4).alias("value"))
    return (rec.where(F.col("rtype") != "")
            .select(F.lower("name").alias("name"), F.col("ttl").cast("int").alias("ttl"), "rtype",
                    F.regexp_replace("value", r'^"|"$', "").alias("value")))


def mail_auth_audit(domains: DataFrame, dns: DataFrame,
                    selectors: Sequence[str] = ()) -> DataFrame:
    """JN11: SPF = apex TXT containing 'v=spf' (case-insensitive); DMARC = any TXT on
    _dmarc.<domain>; DKIM = TXT on <selector>._domainkey.<domain> for the given selectors.
    Left joins on pre-aggregated flags (one row per name), so the domain side is never
    multiplied."""
    txt = dns.where(F.col("rtype") == "TXT")
    spf = (txt.where(F.lower("value").contains("v=spf")).select(F.col("name").alias("domain"))
           .distinct().withColumn("has_spf", F.lit(True)))
    dmarc = (txt.where(F.col("name").startswith("_dmarc."))
             .select(F.expr("substring(name, 8)").alias("domain")).distinct()
             .withColumn("has_dmarc", F.lit(True)))
    out = (domains.select("domain").distinct()
           .join(spf, "domain", "left").join(dmarc, "domain", "left")
           .select("domain", F.coalesce("has_spf", F.lit(False)).alias("has_spf"),
                   F.coalesce("has_dmarc", F.lit(False)).alias("has_dmarc")))
    if selectors:
        dk = txt.select(F.regexp_extract("name", r"^([^.]+)\._domainkey\.(.+)$", 1).alias("sel"),
                        F.regexp_extract("name", r"^([^.]+)\._domainkey\.(.+)$", 2).alias("domain"))
        dk = (dk.where(F.col("sel").isin(list(selectors)))
              .groupBy("domain").agg(F.countDistinct("sel").alias("dkim_selectors")))
        out = (out.join(dk, "domain", "left")
               .withColumn("dkim_selectors", F.coalesce("dkim_selectors", F.lit(0)).cast("bigint")))
    missing = F.concat_ws(",", F.when(~F.col("has_spf"), F.lit("spf")),
                          F.when(~F.col("has_dmarc"), F.lit("dmarc")))
    return out.withColumn("missing", missing)


# --------------------------------------------------------------------------- arrays
def explode_ct_names(ct: DataFrame, scope: DataFrame, col: str = "name_value") -> DataFrame:
    """ARR1: split multi-value names on newline, trim, strip '*.', lower, in-scope
    (suffix match, fixes the substring quirk), distinct."""
    names = ct.select(F.explode(F.split(F.col(col), "\n")).alias("raw"))
    names = names.select(normalize_target("raw").alias("host")).where(F.col("host") != "")
    return in_scope(names, "host", scope).distinct()


def explode_sans(tls: DataFrame) -> DataFrame:
    """ARR2: non-empty SAN entries (these feed the host merge as a source)."""
    return (tls.select("host", F.explode(F.coalesce("san", F.array().cast("array<string>")))
                       .alias("san"))
            .select("host", F.lower(F.trim("san")).alias("san")).where(F.col("san") != "").distinct())


def flatten_passive(docs: DataFrame) -> DataFrame:
    """ARR3: url_list[].url (non-empty), subdomains[], and results[] as
    'url | ip | server' lines with empty defaults. Long form (kind, value)."""
    urls = (docs.select(F.explode("url_list").alias("u")).select(F.col("u.url").alias("value"))
            .where(F.coalesce(F.col("value"), F.lit("")) != "").select(F.lit("url").alias("kind"), "value"))
    subs = (docs.select(F.explode("subdomains").alias("value"))
            .where(F.coalesce(F.col("value"), F.lit("")) != "").select(F.lit("subdomain").alias("kind"), "value"))
    scans = docs.select(F.inline("results")).select(
        F.lit("scan").alias("kind"),
        display_passive(F.col("task.url"), F.col("page.ip"), F.col("page.server")).alias("value"))
    return urls.unionByName(subs).unionByName(scans)


# --------------------------------------------------------------------------- merge / sets
def source_contribution(hosts: DataFrame) -> DataFrame:
    """WIN3: per source (in merge order), distinct hosts and hosts it was first to bring.
    First source per host = min rank (hash aggregate), not a window over all rows."""
    first = hosts.groupBy("host").agg(F.min("source_rank").alias("first_rank"))
    per = hosts.select("host", "source", "source_rank").distinct()
    j = per.join(first, "host")
    return (j.groupBy("source", "source_rank")
            .agg(F.count("*").alias("hosts"),
                 F.sum(F.when(F.col("source_rank") == F.col("first_rank"), 1).otherwise(0))
                 .cast("bigint").alias("new_unique")))


def difference(new: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SET2: rows of ``new`` whose key is not in ``seen`` (anti join keeps all columns)."""
    return new.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def new_only(incoming: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """JN2: anti join on the exact line."""
    return incoming.join(seen.select(key).distinct(), key, "left_anti")


def append_candidates(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """SNK2 logic: lines not already present, deduplicated inside the new lines too."""
    return new_only(incoming, existing, key).dropDuplicates([key])


def asset_diff(prev: DataFrame, curr: DataFrame, key: str = "host") -> DataFrame:
    """SET4: added / removed / kept between two runs (full outer join on the key)."""
    p = prev.select(key).distinct().withColumn("_p", F.lit(True))
    c = curr.select(key).distinct().withColumn("_c", F.lit(True))
    j = p.join(c, key, "full_outer")
    status = (F.when(F.col("_p").isNull(), F.lit("added"))
              .when(F.col("_c").isNull(), F.lit("removed")).otherwise(F.lit("kept")))
    return j.select(key, status.alias("status"))


# --------------------------------------------------------------------------- URLs
def query_params(urls: DataFrame, col: str = "url") -> DataFrame:
    """PRJ5 (re-aimed): parameter inventory: name, number of URLs, one example (min)."""
    kv = urls.select(col, F.explode(F.split(url_query(col), "&")).alias("kv"))
    p = kv.select(col, F.split_part(F.col("kv"), F.lit("="), F.lit(1)).alias("param")).where(
        F.col("param") != "")
    return p.groupBy("param").agg(F.countDistinct(col).alias("urls"), F.min(col).alias("example"))


def collapse_urls(urls: DataFrame, col: str = "url") -> DataFrame:
    """PRJ6: one URL per url_key (the smallest), for an optional collapsed view."""
    return (urls.select(url_key(col).alias("url_key"), F.col(col).alias("url"))
            .groupBy("url_key").agg(F.min("url").alias("url")))


# --------------------------------------------------------------------------- network
def network_ranges(ranges: DataFrame) -> DataFrame:
    """(cidr, asn, family, bits, hi, lo): ranges of both families as the first ``bits`` bits of their
    address; host bits are ignored, and what is no range is left out."""
    parts = F.split("cidr", "/")
    # exploded: the optimizer would write a key's expression out at each of its uses
    r = ranges.select("cidr", "asn", F.explode(F.array(address_key(F.get(parts, F.lit(0))))).alias("key"), F.get(parts, F.lit(1)).try_cast("int").alias("bits"))
    r = r.where((F.size(F.split("cidr", "/")) == 2) & F.col("bits").between(0, F.when(F.col("key.family") == 4, 32).otherwise(128)))
    hi, lo = network_bits(F.col("key.hi"), F.col("key.lo"), F.col("bits"))
    return r.select("cidr", "asn", F.col("key.family").alias("family"), "bits", hi.alias("hi"), lo.alias("lo"))


def ip_to_network(ips: DataFrame, ranges: DataFrame, ip_col: str = "ip", spread: int = 16) -> DataFrame:
    """JN8: address of either family -> CIDR, longest prefix wins (ties: the greatest cidr, then asn). An
    address lies in a range exactly when its network of the range's prefix length is the range's, so
    each distinct address is joined by its networks of the lengths that its family's ranges have, on
    (family, length, network). Networks that may hold very many addresses (IPv4 up to /16, all of IPv6)
    are dealt to ``spread`` keys by a hash of the address. Null and malformed addresses and addresses
    in no range give no row."""
    r = network_ranges(ranges)
    lengths = r.groupBy("family").agg(F.collect_set("bits").alias("lengths"))  # two rows of 33 and 129 values at most
    i = ips.select(F.col(ip_col).alias("ip")).distinct().select("ip", F.explode(F.array(address_key("ip"))).alias("key")).where("key is not null")
    i = i.withColumn("family", F.col("key.family")).join(F.broadcast(lengths), "family").withColumn("bits", F.explode("lengths"))
    hi, lo = network_bits(F.col("key.hi"), F.col("key.lo"), F.col("bits"))
    wide = (F.col("family") == 6) | (F.col("bits") <= 16)
    i = i.select("ip", "family", "bits", hi.alias("hi"), lo.alias("lo"),
                 F.when(wide, F.pmod(F.xxhash64("ip"), F.lit(spread))).otherwise(F.lit(0)).cast("int").alias("salt"))
    r = r.withColumn("salt", F.explode(F.sequence(F.lit(0), F.when(wide, spread - 1).otherwise(0))))
    best = i.join(r, ["family", "bits", "hi", "lo", "salt"]).groupBy("ip").agg(F.max(F.struct("bits", "cidr", "asn")).alias("m"))
    return best.select("ip", F.col("m.cidr").alias("cidr"), F.col("m.asn").alias("asn"), F.col("m.bits").alias("prefix"))


def reverse_dns(ips: DataFrame, ptr: DataFrame, ip_col: str = "ip") -> DataFrame:
    """JN9: left outer equi-join of IPs with PTR records."""
    return ips.select(F.col(ip_col).alias("ip")).distinct().join(ptr, "ip", "left")


def service_inventory(hosts: DataFrame, ports: DataFrame, services: DataFrame) -> DataFrame:
    """JN10: host -> (ip, port) -> detected service, left joins keep unresolved rows."""
    return (hosts.select("host").distinct()
            .join(ports, "host", "left")
            .join(services, ["ip", "port"], "left")
            .select("host", "ip", "port", "service", "version"))


# --------------------------------------------------------------------------- names
# FIXED VALUES: storage name affixes.
BUCKET_SUFFIXES = ("", "-dev", "-staging", "-prod", "-backup", "-data", "-assets",
                   "-static", "-media", "-upload", "-downloads", "-files", "-logs",
                   "-archive", "-temp", "-test", "-public", "-private", "-internal",
                   "-api", "-web", "-app", "-store", "-storage", "-content")
BUCKET_PREFIXES = ("", "dev-", "staging-", "prod-", "backup-", "static-", "assets-",
                   "media-", "upload-", "downloads-", "api-", "app-")
ACCOUNT_SUFFIXES = ("", "dev", "prod", "staging", "backup", "data", "storage")
REALTIME_DB_SUFFIXES = ("app", "prod", "dev", "staging", "api", "web")


def _lits(values):
    return F.array(*[F.lit(v) for v in values])


def name_variants(targets: DataFrame, col: str = "target") -> DataFrame:
    """JN5: candidate storage names per target, generated with generators over literal
    affix arrays (no join): bucket form (12 prefixes x 25 suffixes over org + first two
    name parts; illegal characters -> '-'; length 3..63), storage-account form (7
    suffixes; alphanumeric; first 24; length 3..24) and realtime-database form (org + 6
    suffixes). Distinct (kind, name) via hash aggregate: shared bases such as a common
    second-level label collapse map-side."""
    t = targets.select(normalize_target(col).alias("t"))
    t = t.select(F.split_part(F.col("t"), F.lit("."), F.lit(1)).alias("org"),
                 F.split(F.translate(F.col("t"), "-_", ".."), r"\.").alias("parts"))
    bases = t.select("org", F.explode(F.array_distinct(F.concat(
        F.array(F.col("org")), F.slice("parts", 1, 2)))).alias("base")).distinct()
    b = (bases.select("base", F.explode(_lits(BUCKET_PREFIXES)).alias("pre"))
         .select("base", "pre", F.explode(_lits(BUCKET_SUFFIXES)).alias("suf")))
    bucket = F.regexp_replace(F.lower(F.concat("pre", "base", "suf")), "[^a-z0-9.-]", "-")
    buckets = (b.select(F.lit("bucket").alias("kind"), bucket.alias("name"))
               .where(F.length("name").between(3, 63)))
    acct = F.substring(F.regexp_replace(F.lower(F.concat("base", "suf")), "[^a-z0-9]", ""), 1, 24)
    accounts = (bases.select("base", F.explode(_lits(ACCOUNT_SUFFIXES)).alias("suf"))
                .select(F.lit("account").alias("kind"), acct.alias("name"))
                .where(F.length("name").between(3, 24)))
    orgs = bases.select("org").distinct()
    rtdb = orgs.select(F.lit("realtime_db").alias("kind"), F.explode(F.concat(
        F.array(F.col("org")),
        F.transform(_lits(REALTIME_DB_SUFFIXES), lambda s: F.concat(F.col("org"), F.lit("-"), s))))
        .alias("name"))
    return buckets.unionByName(accounts).unionByName(rtdb).distinct()


def storage_observations(refs: DataFrame) -> DataFrame:
    """Recorded storage observations (provider, name, url, status, body) re-aimed from the
    probes: one per referenced store, status derived from the name."""
    name = (F.when(F.col("provider") == "s3",
                   F.coalesce(F.nullif(F.regexp_extract("ref", r"(?i)^s3://([a-z0-9._-]+)", 1), F.lit("")),
                              F.regexp_extract("ref", r"(?i)^([a-z0-9.-]+)\.s3\.amazonaws\.com", 1)))
            .when(F.col("provider") == "firebase", F.regexp_extract("ref", r"^([a-z0-9-]+)\.", 1))
            .when(F.col("provider") == "gcs", F.regexp_extract("ref", r"googleapis\.com/([a-z0-9._-]+)", 1))
            .otherwise(F.regexp_extract("ref", r"^([a-z0-9]+)\.", 1)))
    h = F.conv(F.substring(F.md5(name), 1, 2), 16, 10).cast("int")
    prov = F.when(F.col("provider") == "firebase", F.lit("firebase-db")).otherwise(F.col("provider"))
    status = F.element_at(F.array(F.lit(200), F.lit(403), F.lit(301), F.lit(404)), (h % 4 + 1))
    body = (F.when(F.col("provider") == "firebase",
                   F.when(h % 2 == 0, F.lit('{"users":{}}')).otherwise(F.lit('{"error":"Permission denied"}')))
            .otherwise(F.lit("")))
    return (refs.select(prov.alias("provider"), name.alias("name"), F.col("ref").alias("url"),
                        status.alias("status"), body.alias("body"))
            .where(F.col("name") != ""))


def match_inventory(variants: DataFrame, obs: DataFrame) -> DataFrame:
    """JN6 (re-aimed): which observed stores carry one of our candidate names (inner
    equi-join on the name), classified by CLS5."""
    from surfacekit.operators.classify import storage_exposure
    v = variants.select("name").distinct()
    return storage_exposure(obs.join(v, "name", "inner"))
