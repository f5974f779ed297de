"""IP addresses of both families as 128-bit keys in two longs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surfacekit.functions.text import IPV4_ANCHORED, ipv4_to_long

_GROUP = "^[0-9a-f]{1,4}$"
_TAIL = r"^(.*:)([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+)$"


def _groups(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def ipv6_hex(col) -> Column:
    """The 32 hex digits of an IPv6 text (any case, one ``::``, a dotted tail), null for others. Zones
    (``%eth0``) and brackets are no part of an address."""
    text = F.lower(F.col(col) if isinstance(col, str) else col)
    tail = F.regexp_extract(text, _TAIL, 2)
    low = F.lpad(F.lower(F.hex(ipv4_to_long(tail))), 8, "0")
    text = F.when(tail == "", text).when(tail.rlike(IPV4_ANCHORED), F.concat(
        F.regexp_extract(text, _TAIL, 1), F.substring(low, 1, 4), F.lit(":"), F.substring(low, 5, 4)))
    halves = F.transform(F.split(text, "::"), _groups)

    def filled(h: Column) -> Column:
        have = F.flatten(h)
        gap = F.when(F.size(h) == 2, F.greatest(8 - F.size(have), F.lit(0))).otherwise(0)
        every = F.concat(h[0], F.array_repeat(F.lit("0"), gap), F.coalesce(F.get(h, F.lit(1)), F.array().cast("array<string>")))
        good = (F.size(h) <= 2) & (F.size(every) == 8) & ((F.size(h) == 1) | (gap > 0)) & F.forall(every, lambda g: g.rlike(_GROUP))
        return F.when(good, F.concat_ws("", F.transform(every, lambda g: F.lpad(g, 4, "0"))))

    # one element, so that the halves are made once
    return F.transform(F.array(halves), filled)[0]


def _long(digits: Column, start: int) -> Column:
    part = lambda at: F.conv(F.substring(digits, at, 8), 16, 10).cast("bigint")
    return F.shiftleft(part(start), 32).bitwiseOR(part(start + 8))


def address_key(col) -> Column:
    """struct(family, hi, lo): 4 with the address in the upper half of hi, or 6; null for no address. An
    IPv4-mapped text (``::ffff:a.b.c.d``) is its IPv4 address."""
    text = F.col(col) if isinstance(col, str) else col
    four = F.struct(F.lit(4).alias("family"), F.shiftleft(ipv4_to_long(text), 32).alias("hi"), F.lit(0).cast("bigint").alias("lo"))

    def six(digits: Column) -> Column:
        mapped = F.struct(F.lit(4).alias("family"), F.shiftleft(F.conv(F.substring(digits, 25, 8), 16, 10).cast("bigint"), 32).alias("hi"),
                          F.lit(0).cast("bigint").alias("lo"))
        own = F.struct(F.lit(6).alias("family"), _long(digits, 1).alias("hi"), _long(digits, 17).alias("lo"))
        return F.when(digits.startswith("0" * 20 + "ffff"), mapped).when(digits.isNotNull(), own)

    return F.when(text.contains(":"), F.transform(F.array(ipv6_hex(text)), six)[0]).when(text.rlike(IPV4_ANCHORED), four)


def network_bits(hi: Column, lo: Column, bits: Column) -> tuple[Column, Column]:
    """The first ``bits`` bits of a key, as two longs shifted to the right."""
    shift = lambda x, n: F.call_function("shiftrightunsigned", x, n)
    zero = F.lit(0).cast("bigint")
    return (F.when(bits == 0, zero).when(bits >= 64, hi).otherwise(shift(hi, 64 - bits)),
            F.when(bits <= 64, zero).otherwise(shift(lo, 128 - bits)))
