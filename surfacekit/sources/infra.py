"""Host, DNS and network observations derived from the page hosts.

Every per-host value comes from bytes of md5(host) (``hb(i)``), so Spark and any other
engine derive identical tables; the work grows with the number of hosts in ``pages``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surfacekit.functions.urls import url_host
from surfacekit.sources import tables as T

# FIXED VALUES: DKIM selectors worth checking.
DKIM_SELECTORS = ("default", "google", "mail", "smtp", "k1", "s1", "selector1", "selector2")
SERVICE_BY_PORT = ((80, "http"), (443, "https"), (22, "ssh"), (3306, "mysql"))


def hb(col: str, i: int) -> Column:
    """Byte ``i`` of md5(col) as an int (0..255)."""
    return F.conv(F.substring(F.md5(F.col(col)), 2 * i + 1, 2), 16, 10).cast("int")


def registrable(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract(c, r"([^.]+\.[^.]+)$", 1)


def host_facts(spark, d) -> DataFrame:
    """host, domain, ip, spf, dmarc, dkim selector, open ports, ptr flag."""
    h = T.pages(spark, d).select(url_host("url").alias("host")).distinct()
    ip = (F.when(hb("host", 0) % 4 == 0,
                 F.concat(F.lit("203.0.113."), (hb("host", 3) % 254 + 1).cast("string")))
          .otherwise(F.concat(F.lit("10."), (hb("host", 1) % 64).cast("string"), F.lit("."),
                              hb("host", 2).cast("string"), F.lit("."),
                              (hb("host", 3) % 254 + 1).cast("string"))))
    ports = F.filter(F.array(F.lit(80), F.lit(443),
                             F.when(hb("host", 7) % 2 == 0, F.lit(8080)),
                             F.when(hb("host", 7) % 3 == 0, F.lit(22)),
                             F.when(hb("host", 7) % 5 == 0, F.lit(3306))),
                     lambda x: x.isNotNull())
    sel = F.element_at(F.array(*[F.lit(s) for s in DKIM_SELECTORS]),
                       (hb("host", 6) % len(DKIM_SELECTORS) + 1).cast("int"))
    return h.select(
        "host", registrable("host").alias("domain"), ip.alias("ip"),
        (hb("host", 4) % 3 != 0).alias("spf"), (hb("host", 5) % 2 == 0).alias("dmarc"),
        F.when(hb("host", 6) % 3 == 0, sel).alias("dkim"),
        F.when(hb("host", 8) % 5 == 0, F.array().cast("array<int>")).otherwise(ports).alias("ports"),
        (hb("host", 9) % 3 != 0).alias("has_ptr"),
        F.concat(F.lit("v"), (hb("host", 10) % 5).cast("string")).alias("version"))


def dns_answer_lines(spark, d) -> DataFrame:
    """(line): resolver answer text per host, with headings and one junk line."""
    f = host_facts(spark, d)
    h, dom, ip = F.col("host"), F.col("domain"), F.col("ip")
    lines = F.array(
        F.concat(F.lit(";; ANSWER SECTION "), h),
        F.concat(h, F.lit(". 300 IN A "), ip),
        F.concat(h, F.lit(". 3600 IN MX 10 mail."), dom, F.lit(".")),
        F.concat(h, F.lit(". 86400 IN NS ns1."), dom, F.lit(".")),
        F.when(F.col("spf"), F.concat(h, F.lit('. 300 IN TXT "v=spf1 include:_spf.'), dom,
                                      F.lit(' ~all"'))),
        F.when(F.col("dmarc"), F.concat(F.lit("_dmarc."), h, F.lit('. 300 IN TXT "v=DMARC1; p=none"'))),
        F.when(F.col("dkim").isNotNull(), F.concat(F.col("dkim"), F.lit("._domainkey."), h,
                                                   F.lit('. 300 IN TXT "v=DKIM1; k=rsa"'))),
        F.concat(F.lit("www."), h, F.lit(". 300 IN CNAME "), h, F.lit(".")),
        F.lit("garbage line without a record"))
    return f.select(F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("line"))


def ports(spark, d) -> DataFrame:
    """ports(host, ip, port)."""
    return host_facts(spark, d).select("host", "ip", F.explode("ports").alias("port"))


def services(spark, d) -> DataFrame:
    """services(ip, port, service, version): detection result for known ports only."""
    m = F.create_map(*[x for p, s in SERVICE_BY_PORT for x in (F.lit(p), F.lit(s))])
    p = ports(spark, d).join(host_facts(spark, d).select("host", "version"), "host")
    return (p.select("ip", "port", m[F.col("port")].alias("service"), "version")
            .where(F.col("service").isNotNull()).distinct())


def tls(spark, d) -> DataFrame:
    """tls(host, cn, san): certificates of hosts serving 443."""
    f = host_facts(spark, d).where(F.array_contains("ports", 443))
    san = F.array(F.col("host"), F.concat(F.lit("www."), F.col("host")),
                  F.concat(F.lit("api."), F.col("domain")), F.lit(""))
    return f.select("host", F.col("host").alias("cn"), san.alias("san"))


def ptr(spark, d) -> DataFrame:
    """ptr(ip, name)."""
    f = host_facts(spark, d).where("has_ptr")
    return f.select("ip", F.concat(F.lit("host-"), F.regexp_replace("ip", r"\.", "-"),
                                   F.lit(".static.example.net")).alias("name")).distinct()


def ct_entries(spark, d) -> DataFrame:
    """ct_entries(name_value): newline-separated names per page, with wildcard, upper-case,
    foreign and e-mail entries."""
    p = T.pages(spark, d).select(url_host("url").alias("host"))
    p = p.withColumn("domain", registrable("host"))
    nv = F.concat_ws("\n", F.col("host"), F.concat(F.lit("*."), F.col("host")), F.upper("host"),
                     F.concat(F.lit("www."), F.col("host")),
                     F.concat(F.col("host"), F.lit(".mirror.invalid")),
                     F.concat(F.lit(" "), F.col("domain"), F.lit(" ")),
                     F.concat(F.lit("admin@"), F.col("domain")))
    return p.select(nv.alias("name_value"))


def scope_domains(spark, d) -> DataFrame:
    """Registrable domains of the page hosts (the targets)."""
    return (T.pages(spark, d).select(registrable(url_host("url")).alias("domain")).distinct())


# FIXED VALUES: network ranges (nested, for longest-prefix matching).
ASN_RANGES = (
    ("10.0.0.0/8", "AS64500 corp-backbone"),
    ("10.0.0.0/10", "AS64501 dc-east"),
    ("10.16.0.0/12", "AS64502 dc-east-apps"),
    ("10.32.0.0/11", "AS64503 dc-west"),
    ("203.0.113.0/24", "AS64510 edge"),
    ("198.51.100.0/24", "AS64511 unused"),
)


def asn_ranges(spark) -> DataFrame:
    return spark.createDataFrame(list(ASN_RANGES), "cidr string, asn string")


# FIXED VALUES: network ranges of the other family (nested, one with host bits).
ASN_RANGES_V6 = (
    ("2001:db8::/32", "AS64520 v6-edge"),
    ("2001:DB8:8000::/33", "AS64521 v6-edge-upper"),
    ("2001:db8:0:0::/64", "AS64522 v6-core"),
    ("fd00::1/8", "AS64523 v6-private"),
    ("fd00:4000::/18", "AS64524 v6-private-lab"),
)


def asn_ranges_both(spark) -> DataFrame:
    return spark.createDataFrame(list(ASN_RANGES + ASN_RANGES_V6), "cidr string, asn string")


def address_lines(spark, d) -> DataFrame:
    """(line): A and AAAA answers per host; the IPv6 texts are whole and in upper case, shortened at
    the end or in the middle, or hold an IPv4 address."""
    f = host_facts(spark, d).select("host", "ip", F.md5("host").alias("m"), (hb("host", 11) % 4).alias("form"))
    g = lambda i: F.substring("m", 4 * i + 1, 4)
    six = (F.when(F.col("form") == 0, F.upper(F.concat_ws(":", F.lit("2001:db8"), *map(g, range(6)))))
           .when(F.col("form") == 1, F.concat(F.lit("2001:db8::"), g(0)))
           .when(F.col("form") == 2, F.concat(F.lit("fd00:"), g(0), F.lit("::"), g(1), F.lit(":"), g(2)))
           .otherwise(F.concat(F.lit("::ffff:"), F.col("ip"))))
    return f.select(F.explode(F.array(F.concat("host", F.lit(". 300 IN A "), "ip"),
                                      F.concat("host", F.lit(". 300 IN AAAA "), six))).alias("line"))


def passive_docs(spark, d) -> DataFrame:
    """Passive-source documents with the nested shapes of archive / scan / subdomain APIs."""
    p = T.pages(spark, d).select("url", url_host("url").alias("host"))
    f = host_facts(spark, d).select("host", "ip")
    p = p.join(f, "host", "left")
    url_list = F.array(F.struct(F.col("url").alias("url")), F.struct(F.lit("").alias("url")))
    results = F.array(F.struct(F.struct(F.col("url").alias("url")).alias("task"),
                               F.struct(F.col("ip").alias("ip"),
                                        F.lit(None).cast("string").alias("server")).alias("page")))
    subs = F.array(F.col("host"), F.concat(F.lit("www."), F.col("host")))
    return p.select(url_list.alias("url_list"), results.alias("results"), subs.alias("subdomains"))
