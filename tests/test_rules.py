"""Each secret rule with one positive and one negative text, and the quirk decisions.

Token-like strings are assembled at run time from parts, so no credential-shaped literal
is stored in the repository."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.operators import secrets as SE


def tok(n: int, alphabet: str = "abcdefghijklmnop") -> str:
    return (alphabet * (n // len(alphabet) + 1))[:n]


POSITIVE = {
    "AWS_Access_Key": "k = " + "AK" + "IA" + tok(16, "QRSTUVWXYZ"),
    "AWS_Secret_Key": "aws_secret_access_key = '" + tok(40) + "'",
    "Google_API_Key": "x=" + "AI" + "za" + tok(35) + ";",
    "Google_OAuth": "t " + "ya" + "29." + tok(60) + " ",
    "GitHub_Token": "t=" + "gh" + "p_" + tok(40) + " ",
    "Slack_Token": "s=" + "xo" + "xb-" + tok(20) + " ",
    "Stripe_Secret": "s=" + "sk" + "_live_" + tok(24) + " ",
    "Stripe_PK": "s=" + "pk" + "_test_" + tok(24) + " ",
    "Sendgrid": "s=" + "SG." + tok(22) + "." + tok(43) + " ",
    "Twilio_SID": "s=" + "AC" + tok(32) + " ",
    "Private_Key_PEM": "-----BEGIN RSA PRIVATE KEY-----",
    "JWT_Token": "j=" + "ey" + "J" + tok(12) + ".eyJ" + tok(12) + "." + tok(12) + " ",
    "Mailgun_Key": "m=" + "key" + "-" + tok(32) + " ",
    "Shopify_Token": "s=" + "shp" + "ss_" + tok(32) + " ",
    "Shopify_Shared": "s=" + "shp" + "at_" + tok(32) + " ",
    "Firebase_URL": "https://" + "my-app" + ".firebaseio.com",
    "DB_ConnString": "postgres://" + "app:" + tok(10) + "@db.internal/x",
    "Bearer_Token": "Authorization Bearer " + tok(30) + " ",
    "Auth_Header": '"Authorization": "' + tok(20) + '"',
    "API_Key_Assign": 'api_key = "' + tok(20) + '"',
    "Secret_Assign": 'client_secret: "' + tok(20) + '"',
    "Token_Assign": 'access_token = "' + tok(20) + '"',
    "Password_Assign": 'password = "' + tok(12) + '"',
    "S3_Bucket_Ref": "s3://" + "my-backups",
    "Azure_Conn": "DefaultEndpointsProtocol=https;AccountName=acct;AccountKey=" + tok(30) + ";",
    "Internal_IP": "host 10.1.2.3 here",
    "GQL_Endpoint": 'url: "/graphql"',
    "Generic_Credential": 'login = "' + tok(10) + '"',
    "OAuth_Client_ID": 'client_id: "' + tok(16) + '"',
    "Webhook_URL": "https://hooks.slack.com/services/" + tok(12),
    "Mapbox_Token": "m=" + "pk." + "eyJ" + tok(24) + " ",
    "Algolia_Key": 'algolia_api_key = "' + tok(16) + '"',
    "Generic_Token_Hex": 'token = "' + ("0123456789abcdef" * 3)[:40] + '"',
    "IPv4_Literal": "addr 192.0.2.7.",
    "Email_Address": "mail ops@corp-mail.org now",
}
NEGATIVE = {
    "AWS_Access_Key": "xAK" + "IA" + tok(16, "QRSTUVWXYZ"),   # glued to a word: no boundary
    "Internal_IP": "v 10.1.2.3.4 and 1.10.1.2.3",               # part of a longer dotted run
    "IPv4_Literal": "v 1.2.3.456",
    "Email_Address": "no at sign here",
    "Private_Key_PEM": "-----BEGIN PUBLIC KEY-----",
    "Google_API_Key": "AI" + "za" + tok(10),
    "AWS_Secret_Key": "aws_secret_access_key = '" + tok(20) + "'",
    "GitHub_Token": "gh" + "x_" + tok(40),
    "Slack_Token": "xo" + "xz-" + tok(20),
    "Stripe_Secret": "sk" + "_prod_" + tok(24),
    "Sendgrid": "SG." + tok(10) + "." + tok(10),
    "Twilio_SID": "AC" + tok(12),
    "JWT_Token": "eyJ" + tok(5) + "." + tok(5),
    "Mailgun_Key": "key" + "-" + tok(10),
    "Firebase_URL": "https://ab.firebaseio.com",
    "DB_ConnString": "mysql://a",
    "Bearer_Token": "bearer short",
    "API_Key_Assign": 'api_key = "short"',
    "Password_Assign": 'password = "short"',
    "S3_Bucket_Ref": "s3://ab",
    "Webhook_URL": "https://hooks.example.org/services/x",
    "Generic_Token_Hex": 'token = "' + "0123456789abcdef" + '"',
}


def _scan(spark, text: str, rule_name: str):
    rule = [r for r in rules.SECRET_RULES if r.name == rule_name]
    df = spark.createDataFrame([("doc://t/1", text)], "url string, content string")
    return [row.raw for row in SE.scan_secrets(df, rule).collect()]


@pytest.mark.parametrize("name", sorted(POSITIVE))
def test_rule_positive(spark, name):
    assert _scan(spark, POSITIVE[name], name), name


@pytest.mark.parametrize("name", sorted(NEGATIVE))
def test_rule_negative(spark, name):
    assert _scan(spark, NEGATIVE[name], name) == [], name


def test_all_rules_covered():
    assert {r.name for r in rules.SECRET_RULES} <= set(POSITIVE) | {"GitHub_Classic"}


def test_boundary_ascii_semantics(spark):
    # accented letter before the token: ASCII boundary semantics -> it is a boundary
    text = "é" + "AK" + "IA" + tok(16, "QRSTUVWXYZ") + " x"
    assert len(_scan(spark, text, "AWS_Access_Key")) == 1
    # adjacent matches separated by one non-word char are both found
    one = "AK" + "IA" + tok(16, "QRSTUVWXYZ")
    assert len(_scan(spark, one + "," + one, "AWS_Access_Key")) == 2


def test_q4_pem_with_algorithm(spark):
    assert _scan(spark, "-----BEGIN RSA PRIVATE KEY-----", "Private_Key_PEM")
    assert _scan(spark, "-----BEGIN PRIVATE KEY-----", "Private_Key_PEM")


def test_q1_match_key_keeps_letter_s(spark):
    df = spark.createDataFrame([("a", 'password = "sesame-s3cret"')], "url string, content string")
    rows = SE.keyed(SE.scan_secrets(df, [r for r in rules.SECRET_RULES if r.name == "Password_Assign"])).collect()
    assert rows and rows[0].clean == "passwordsesame-s3cret"


def test_noise_and_exemption(spark):
    df = spark.createDataFrame([("a", 'api_key = "YOUR_API_KEY_HERE"'),
                                ("b", 'token = "' + ("0123456789abcdef" * 3)[:40] + '"')],
                               "url string, content string")
    kept = {r.url for r in SE.drop_noise(SE.scan_secrets(df)).collect()}
    assert "a" not in kept and "b" in kept


def test_offsets_slice_to_match(spark):
    text = ("xx 10.0.0.1 yy 10.0.0.1\n" * 3) + POSITIVE["Slack_Token"] * 2
    df = spark.createDataFrame([("d", text)], "url string, content string")
    for r in SE.scan_secrets(df).collect():
        assert text[r.offset:r.offset + len(r.raw)] == r.raw


def test_masking_never_leaks(spark):
    """No token-like run (>= 12 key characters) of any match -- the finding's own or a
    neighbour's inside the window -- appears in an output match or context."""
    import re
    text = " ".join(POSITIVE.values())
    df = spark.createDataFrame([("d", text)], "url string, content string")
    runs = {x for r in SE.keyed(SE.scan_secrets(df)).collect()
            for x in re.findall(r"[A-Za-z0-9_+/-]{12,}", r.raw)}
    assert runs
    for f in SE.findings(SE.scan_secrets(df)).collect():
        for run in runs:
            assert run not in f.context and run not in f.match


def test_java_form_rewrites_are_equivalent(spark):
    """The leading-boundary rewrite gives the same matches as the general look-around form
    on tricky neighbours (underscore, hyphen, glued letters, trailing non-word chars)."""
    one = "AK" + "IA" + tok(16, "QRSTUVWXYZ")
    texts = ["_" + one, "-" + one, one + "Z", "x" + one + " " + one, "gh" + "p_" + tok(36) + "-",
             "bearer  " + tok(25), "é" + one, "pk" + ".eyJ" + tok(30) + "_", "AC" + tok(32) + "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rules.SECRET_RULES:
        if r.java:
            continue
        fast = rules.java_form(r.pattern)
        general = rules.java_form(r.pattern, lead_rewrite=False)
        a = [x[0] for x in df.select(F.regexp_extract_all("t", F.lit(fast), 0)).collect()]
        b = [x[0] for x in df.select(F.regexp_extract_all("t", F.lit(general), 0)).collect()]
        assert a == b, r.name
