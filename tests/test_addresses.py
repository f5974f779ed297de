"""JN8 over both address families, against the standard library's addresses."""

from __future__ import annotations

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from surfacekit.functions.addresses import address_key, ipv6_hex
from surfacekit.operators import inventory as INV

BAD = (None, "", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7::8", "12345::", "g::1", "fe80::1%eth0",
       "[::1]", "::1.2.3", "::1.2.3.256", "1.2.3", "1.2.3.4.5", "300.1.1.1", ":1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:", "::1 ")


def texts(rng: random.Random, n: int) -> list[str]:
    out = ["::", "::1", "1::", "::ffff:10.1.2.3", "64:ff9b::192.0.2.33", "ffff:" * 7 + "ffff", "0.0.0.0", "255.255.255.255"]
    for _ in range(n):
        v6 = ipaddress.IPv6Address(rng.choice((0x20010DB8 << 96, 0xFD << 120)) | rng.getrandbits(rng.choice((8, 64, 96))))
        out += [str(v6), v6.exploded.upper(), str(ipaddress.IPv4Address(rng.getrandbits(32))), f"10.{rng.getrandbits(6)}.0.{rng.getrandbits(8)}"]
    return out


def meant(text: str):
    address = ipaddress.ip_address(text)
    return getattr(address, "ipv4_mapped", None) or address


def test_digits_and_keys_are_the_standard_ones(spark):
    given = [(t,) for t in texts(random.Random(1), 60)]
    rows = spark.createDataFrame(given, "ip string").select("ip", ipv6_hex("ip").alias("hex"), address_key("ip").alias("key")).collect()
    for r in rows:
        if ":" in r["ip"]:
            assert r["hex"] == f"{int(ipaddress.IPv6Address(r['ip'])):032x}"
        value = (r["key"]["hi"] % 2**64) << 64 | r["key"]["lo"] % 2**64
        address = meant(r["ip"])
        assert (r["key"]["family"], value) == (address.version, int(address) << (96 if address.version == 4 else 0))


def test_malformed_addresses_have_no_key(spark):
    rows = spark.createDataFrame([(t,) for t in BAD], "ip string").select("ip", address_key("ip").alias("key"))
    assert [r["ip"] for r in rows.collect() if r["key"] is not None] == []


@pytest.mark.parametrize("spread", [1, 16])
def test_longest_prefix_of_both_families(spark, spread):
    rng = random.Random(2)
    ranges = [("0.0.0.0/0", "default"), ("::/0", "default 6"), ("2001:db8::/32", "a"), ("fd00::/8", "b"), ("10.0.0.0/8", "c"), ("10.5.0.9/32", "host")]
    for k in range(120):
        v6 = ipaddress.ip_network((rng.choice((0x20010DB8 << 96, 0xFD << 120)) | rng.getrandbits(96), rng.randrange(33, 129)), strict=False)
        v4 = ipaddress.ip_network((10 << 24 | rng.getrandbits(22), rng.randrange(9, 33)), strict=False)
        ranges += [(str(v6), f"six {k}"), (str(v4), f"four {k}")]
    ranges += [("64:ff9b::/96", "nat"), ("ffff::/128", "none"), ("::1/128", "loop"), ("2001:db8::/64", "mid"), ("2001:db8::/65", "low")]
    bad = [(None, "x"), ("", "x"), ("10.0.0.0", "x"), ("10.0.0.0/33", "x"), ("::/129", "x"), ("10.0.0.0/-1", "x"), ("10.0.0.0/8/8", "x"), ("nonsense/8", "x")]
    ips = texts(rng, 150) + [str(ipaddress.ip_network(c)[0]) for c, _ in ranges[-60:] if "/0" not in c]
    df = spark.createDataFrame([(t, "clash") for t in [*ips, *ips[:9], *BAD]], "ip string, cidr string")
    got = {r["ip"]: (r["cidr"], r["prefix"]) for r in INV.ip_to_network(df, spark.createDataFrame(ranges + bad, "cidr string, asn string"), spread=spread).collect()}
    nets = [(ipaddress.ip_network(c, strict=False), c) for c, _ in ranges]
    want = {}
    for t in set(ips):
        held = [(n.prefixlen, c) for n, c in nets if n.version == meant(t).version and meant(t) in n]
        if held:
            want[t] = max(held)[::-1]
    assert got == want


def test_one_network_of_all_addresses_is_dealt_out(spark):
    ips = spark.range(4000).select(F.concat(F.lit("2001:db8::"), F.lower(F.hex("id"))).alias("ip"))
    out = INV.ip_to_network(ips, spark.createDataFrame([("2001:db8::/32", "a"), ("2001:db8::/64", "b")], "cidr string, asn string"))
    assert [tuple(r) for r in out.groupBy("asn", "prefix").count().collect()] == [("b", 64, 4000)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "ip string")
    ranges = spark.createDataFrame([("::/0", "a")], "cidr string, asn string")
    assert INV.ip_to_network(none, ranges).count() == 0
    assert INV.ip_to_network(spark.createDataFrame([("::1",)], "ip string"), ranges.limit(0)).count() == 0
