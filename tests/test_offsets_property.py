"""Property: for random texts, the scanner's (rule, match, offset) list equals Python's
``re.finditer`` run on the same Java-form patterns (ASCII semantics), i.e. offsets from
split gap lengths are exactly the finditer starts."""

from __future__ import annotations

import random
import re

from surfacekit import rules
from surfacekit.operators import secrets as SE

FRAGMENTS = [
    "AK" + "IA" + "QRSTUVWXYZQRSTUV", "gh" + "p_" + "abcdefghijklmnopqrstuvwxyzabcdefghij",
    "10.0.3.7", "192.168.1.20", "1.10.0.1.2", "ops@corp-mail.org", "x.y@z.io",
    'password = "sesame12345"', "api_key: 'abcdefghijklmnop'", "Bearer abcdefghijklmnopqrstuvwx",
    "s3://bucket-name", "https://hooks.slack.com/services/abcdefghijkl", "AC" + "abcdefabcdefabcdefabcdefabcdefab",
    "-----BEGIN PRIVATE KEY-----", 'token = "' + "0123456789abcdef" * 2 + '01234567"', "eyJ" + "a" * 12,
    "postgres://u:pw12345678@h/db", "key-" + "Ab1" * 11, "xo" + "xb-1234567890ab",
]
SEPARATORS = [" ", "", "_", "-", "é", "\n", ",", ".", "'", '"', "=", ":", "/", "x"]


def _texts(n: int = 300, seed: int = 7) -> list[str]:
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(1, 6)):
            parts.append(rnd.choice(SEPARATORS))
            parts.append(rnd.choice(FRAGMENTS))
        parts.append(rnd.choice(SEPARATORS))
        out.append("".join(parts))
    return out


def _expected(texts):
    exp = set()
    for i, t in enumerate(texts):
        for r in rules.SECRET_RULES:
            pat = re.compile(r.spark_pattern, re.ASCII)
            for m in pat.finditer(t):
                if r.spark_keep and not re.search(r.spark_keep, m.group(0), re.ASCII):
                    continue
                exp.add((f"d{i}", r.ord, m.group(0), m.start()))
    return exp


def test_offsets_equal_finditer(spark):
    texts = _texts()
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "url string, content string")
    got = {(r.url, r.rule_ord, r.raw, r.offset) for r in SE.scan_secrets(df).collect()}
    exp = _expected(texts)
    assert exp and got == exp
