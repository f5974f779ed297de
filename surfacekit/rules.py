"""Rule catalogs: ordered, small, literal.

Every pattern here is compiled once per task as a literal regex inside a single projection
(never a pattern *column*, never a corpus x rules cross join). Patterns are written in the
common subset of Java regex (Spark) and RE2 (DuckDB oracle); where the two engines differ
(``\\b`` on accented text, look-behind) the Spark form is derived by ``java_form`` below.

Sections marked FIXED VALUES hold values that must equal the reference tool's for equal
results; they are kept as plain text, in their natural order. Deliberate fixes of the
reference's quirks are marked "fix:" next to the value they change.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# ---------------------------------------------------------------------------------------
# Engine forms of a word boundary and of whitespace.
# Java (JDK 17) and Python treat accented letters as word characters for \b; RE2 treats
# only ASCII. We choose the ASCII semantics everywhere and spell it out in Java with
# look-arounds, which consume nothing (adjacent matches are not lost). Java's \s also
# matches a vertical tab, RE2's does not; we spell the RE2 set out as well.
_W = "[A-Za-z0-9_]"
JAVA_WORD_BOUNDARY = f"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"
_WS = r" \t\n\f\r"


_LEAD_LITERAL = re.compile(r"[A-Za-z0-9_]+")
_LEAD_ALT = re.compile(r"\(((?:[A-Za-z0-9_]+\|)+[A-Za-z0-9_]+)\)")
_LEAD_CLASS = re.compile(r"\[(?:A-Za-z0-9_|A-Za-z0-9|a-zA-Z0-9_|a-zA-Z0-9|0-9A-Za-z_?)\]")


def _lead_boundary(rest: str) -> str | None:
    """Rewrite a leading ASCII word boundary that precedes a fixed-length word-character
    element E as ``E(?<![A-Za-z0-9_].{n})``: the boundary is checked behind E, after E
    matched, so Java scans for E's first character instead of evaluating look-arounds at
    every position. Exactly equivalent (E is all word characters of length n)."""
    m = _LEAD_LITERAL.match(rest)
    if m and not rest[m.end():m.end() + 1] in ("{", "*", "+", "?"):
        n = len(m.group(0))
        return m.group(0) + f"(?<!{_W}.{{{n}}})" + rest[m.end():]
    m = _LEAD_ALT.match(rest)
    if m:
        alts = m.group(1).split("|")
        if len({len(a) for a in alts}) == 1 and rest[m.end():m.end() + 1] not in ("{", "*", "+", "?"):
            n = len(alts[0])
            return m.group(0) + f"(?<!{_W}.{{{n}}})" + rest[m.end():]
    m = _LEAD_CLASS.match(rest)
    if m and rest[m.end():m.end() + 1] not in ("{", "*", "+", "?"):
        return m.group(0) + f"(?<!{_W}.)" + rest[m.end():]
    return None


def java_form(pattern: str, lead_rewrite: bool = True) -> str:
    r"""Spark (Java regex) form of a portable pattern with RE2 semantics for ``\b``/``\s``."""
    flags = "(?i)" if pattern.startswith("(?i)") else ""
    body = pattern[len(flags):]
    if lead_rewrite and body.startswith(r"\b"):
        lead = _lead_boundary(body[2:])
        if lead is not None:
            body = lead
    out = flags + body.replace(r"\b", JAVA_WORD_BOUNDARY)
    out = out.replace(r"[^\s", "[^" + _WS)
    out = re.sub(r"(?<!\[\^)\\s", lambda _: "[" + _WS + "]", out)
    return out


# ---------------------------------------------------------------------------------------
# FIXED VALUES: URL classification patterns (case-insensitive, as grep -iE used them).
SENSITIVE_EXTS = (
    r"\.(xls|xml|xlsx|json|pdf|sql|doc|docx|pptx|txt|zip|tar\.gz|tgz|bak|7z|rar|"
    r"log|cache|secret|db|backup|yml|yaml|exe|dll|bin|ini|bat|sh|deb|rpm|iso|img|"
    r"apk|msi|dmg|tmp|crt|pem|key|pub|asc|env|sqlite|pfx|config|swp|passwords)(\?|$)"
)
ADMIN_PATTERN = (
    r"/(admin|administrator|dashboard|panel|manage|backend|control|cp|wp-admin|"
    r"phpmyadmin|adminer|webmin|cpanel|jenkins|grafana|kibana|sonar|portainer|rancher)(/|$|\?)"
)
API_PATTERN = (
    r"(/api/|/v[0-9]+/|/rest/|/graphql|/rpc/|/service/|/services/|/endpoint/|/endpoints/)"
)
KEYWORD_PATTERN = (
    r"(token|secret|key|auth|password|pass|pwd|credential|session|jwt|oauth|sso|"
    r"saml|csrf|debug|internal|staging|test|dev|backup|config|upload|download|file|"
    r"import|export|payment|invoice|receipt|report|user|account|profile|billing|cart|checkout)"
)
API_ROUTE_PATTERN = r"/api/|/v[0-9]+/|/rest/|/rpc/"
JS_URL_PATTERN = r"\.js(\?|$|#)"
VENDOR_JS_PATTERN = (
    r"(jquery|bootstrap|angular|react|vue|lodash|moment|webpack|"
    r"cdn\.cloudflare|googleapis\.com|gstatic\.com|unpkg\.com|jsdelivr\.net|"
    r"cdnjs\.cloudflare|polyfill\.io)"
)
# crawler exclusion list (png,jpg,jpeg,gif,css,woff,woff2,svg,ico)
STATIC_ASSET_PATTERN = r"\.(png|jpg|jpeg|gif|css|woff|woff2|svg|ico)(\?|$)"
# fix (high-impact files): the original demands a literal "." before every name, so
# "/Dockerfile", "/.htaccess" and "/.git/config" never match. Ours matches the file name
# at the start of the last path segment.
HIGH_IMPACT_FILES = (
    r"(^|/)(\.env|\.git/config|\.git/?|[^/?#]*\.config|phpinfo(\.php)?|php\.ini|"
    r"settings\.py|composer\.json|package\.json|Dockerfile|docker-compose(\.ya?ml)?|"
    r"\.htaccess|\.htpasswd|[^/?#]*\.(backup|sql|dump))(\?|#|$)"
)


# ---------------------------------------------------------------------------------------
# CLS1 risk buckets. The original delegates these to pattern files it does not ship; these
# are our own parameter-name rules (a query parameter named like the sink of the class).
@dataclass(frozen=True)
class UrlRule:
    tag: str
    pattern: str  # portable, matched case-insensitively on the whole URL


def _params(*names: str) -> str:
    return r"[?&](" + "|".join(names) + r")="


URL_TAG_RULES: tuple[UrlRule, ...] = (
    UrlRule("xss", _params("q", "s", "search", "query", "keyword", "lang", "message",
                           "comment", "name", "callback", "html")),
    UrlRule("sqli", _params("id", "uid", "pid", "cat", "category", "order", "sort", "where",
                            "column", "table", "row", "select", "filter")),
    UrlRule("ssrf", _params("url", "uri", "dest", "host", "domain", "feed", "proxy",
                            "fetch", "image_url", "webhook", "site")),
    UrlRule("ssti", _params("template", "tpl", "view", "render", "preview", "content")),
    UrlRule("redirect", _params("redirect", "redirect_uri", "redirect_url", "return",
                                "return_to", "returnurl", "next", "goto", "continue",
                                "target", "out", "ref")),
    UrlRule("rce", _params("cmd", "exec", "command", "execute", "run", "ping", "shell",
                           "process", "daemon")),
    UrlRule("idor", _params("user_id", "account_id", "order_id", "invoice", "doc_id",
                            "profile", "uid", "number", "user")),
    UrlRule("lfi", _params("file", "path", "folder", "dir", "include", "page", "doc",
                           "document", "download", "filename")),
    UrlRule("debug", _params("debug", "test", "trace", "verbose", "env", "config",
                             "admin")),
    UrlRule("cors", _params("origin", "callback", "jsonp", "cors")),
    UrlRule("aws-key", r"(AKIA|ASIA)[0-9A-Z]{16}|aws_access_key_id|x-amz-credential"),
    UrlRule("s3", r"s3://|\.s3[.-]([a-z0-9-]+\.)?amazonaws\.com|s3\.amazonaws\.com/"),
)

# The URL groups of the original besides the risk buckets, each as a tag of the single scan.
URL_GROUP_RULES: tuple[UrlRule, ...] = (
    UrlRule("sensitive", SENSITIVE_EXTS),
    UrlRule("high_impact", HIGH_IMPACT_FILES),
    UrlRule("admin", ADMIN_PATTERN),
    UrlRule("api", API_PATTERN),
    UrlRule("keyword", KEYWORD_PATTERN),
    UrlRule("js", JS_URL_PATTERN),
)

ALL_URL_RULES = URL_TAG_RULES + URL_GROUP_RULES


# ---------------------------------------------------------------------------------------
# Secret rules (EXT1).
@dataclass(frozen=True)
class SecretRule:
    ord: int
    name: str
    tier: int
    pattern: str                 # portable pattern, group 0 is the match
    anchors: tuple[str, ...] = ()  # lower-case literals every match contains (gate)
    keep: str | None = None      # anchored post-filter on each candidate (see Internal_IP)
    noise_exempt: bool = False   # exempt from the hex-run part of the noise rule only
    origin: str = "ref"          # "ref" = reference rule, "ours" = added rule
    java: str | None = None      # look-around form when it is exactly equivalent and cheaper
    # Where a match may begin: ``lead`` characters at most before an anchor it holds, or, given a
    # string, any number of these characters before it. None: anywhere.
    lead: int | str | None = None
    # A cheap pattern: every match begins inside one of this pattern's matches.
    starts: str | None = None

    @property
    def spark_pattern(self) -> str:
        return self.java if self.java else java_form(self.pattern)

    @property
    def spark_keep(self) -> str | None:
        return None if self.java else self.keep


# FIXED VALUES: secret patterns and tiers, in the original order. GitHub_Classic is kept
# although dedup shadows it behind GitHub_Token. Private_Key_PEM carries a fix: the
# original needs " KEY" right after the algorithm, so "RSA PRIVATE KEY" never matched.
# Internal_IP needs look-behind, which RE2 lacks; the exact equivalent used by both
# engines is: take maximal runs of [0-9./]+ and keep runs that match the anchored form.
_INTERNAL_IP = (r"(10\.\d{1,3}\.\d{1,3}\.\d{1,3}|172\.(1[6-9]|2[0-9]|3[01])\.\d{1,3}\.\d{1,3}"
                r"|192\.168\.\d{1,3}\.\d{1,3})")

_LOWER = "abcdefghijklmnopqrstuvwxyz0123456789"

SECRET_RULES: tuple[SecretRule, ...] = (
    SecretRule(1, "AWS_Access_Key", 1, r"\bAKIA[0-9A-Z]{16}\b", ("akia",), noise_exempt=True, lead=0),
    SecretRule(2, "AWS_Secret_Key", 1,
               r"(?i)aws_secret_access_key\s*[=:]\s*['\"']?([A-Za-z0-9/+]{40})",
               ("aws_secret_access_key",), lead=0),
    SecretRule(3, "Google_API_Key", 1, r"\bAIza[0-9A-Za-z_-]{35}\b", ("aiza",), noise_exempt=True, lead=0),
    SecretRule(4, "Google_OAuth", 1, r"\bya29\.[0-9A-Za-z_-]{50,}\b", ("ya29.",), noise_exempt=True, lead=0),
    SecretRule(5, "GitHub_Token", 1, r"\b(ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9_]{36,255}\b",
               ("gh",), noise_exempt=True, lead=0),
    SecretRule(6, "GitHub_Classic", 1, r"\bghp_[A-Za-z0-9]{36}\b", ("ghp_",), noise_exempt=True, lead=0),
    SecretRule(7, "Slack_Token", 1, r"\bxox[baprs]-[0-9A-Za-z]{10,255}\b", ("xox",),
               noise_exempt=True, lead=0),
    SecretRule(8, "Stripe_Secret", 1, r"\bsk_(test|live)_[0-9a-zA-Z]{20,}\b", ("sk_",),
               noise_exempt=True, lead=0),
    SecretRule(9, "Stripe_PK", 1, r"\bpk_(test|live)_[0-9a-zA-Z]{20,}\b", ("pk_",),
               noise_exempt=True, lead=0),
    SecretRule(10, "Sendgrid", 1, r"\bSG\.[a-zA-Z0-9_-]{22}\.[a-zA-Z0-9_-]{43}\b", ("sg.",),
               noise_exempt=True, lead=0),
    SecretRule(11, "Twilio_SID", 1, r"\bAC[a-z0-9]{32}\b", ("ac",), noise_exempt=True, lead=0),
    SecretRule(12, "Private_Key_PEM", 1,
               r"-----BEGIN ((RSA|EC|DSA|OPENSSH|ENCRYPTED) )?PRIVATE KEY",  # fix
               ("-----begin",), lead=0),
    SecretRule(13, "JWT_Token", 1,
               r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\b",
               ("eyj",), noise_exempt=True, lead=0),
    SecretRule(14, "Mailgun_Key", 1, r"\bkey-[0-9a-zA-Z]{32}\b", ("key-",), noise_exempt=True, lead=0),
    SecretRule(15, "Shopify_Token", 1, r"\bshpss_[a-zA-Z0-9]{32,}\b", ("shpss_",),
               noise_exempt=True, lead=0),
    SecretRule(16, "Shopify_Shared", 1, r"\bshpat_[a-zA-Z0-9]{32,}\b", ("shpat_",),
               noise_exempt=True, lead=0),
    SecretRule(17, "Firebase_URL", 1, r"https://[a-z0-9-]{4,}\.firebaseio\.com",
               ("firebaseio.com",), lead=_LOWER + "-.:/"),
    SecretRule(18, "DB_ConnString", 1,
               r"(?i)(mysql|postgresql|postgres|mongodb|redis)://[^\s<>\"']{8,}", ("://",), lead=10),
    SecretRule(19, "Bearer_Token", 2, r"(?i)\bbearer\s+([A-Za-z0-9_\-\.]{20,})\b", ("bearer",), lead=0),
    SecretRule(20, "Auth_Header", 2,
               r"(?i)['\"]?authorization['\"]?\s*:\s*['\"]([^'\"]{12,})['\"]",
               ("authorization",), lead=1),
    SecretRule(21, "API_Key_Assign", 2,
               r"(?i)(api[_-]?key|apikey|api[_-]?secret)\s*[=:]\s*['\"]([^'\"]{12,})['\"]",
               ("api",), lead=0),
    SecretRule(22, "Secret_Assign", 2,
               r"(?i)(secret|client_secret|app_secret)\s*[=:]\s*['\"]([^'\"]{12,})['\"]",
               ("secret",), lead=7),
    SecretRule(23, "Token_Assign", 2,
               r"(?i)(access[_-]?token|auth[_-]?token|refresh[_-]?token)\s*[=:]\s*['\"]([^'\"]{12,})['\"]",
               ("token",), lead=8),
    SecretRule(24, "Password_Assign", 2,
               r"(?i)(password|passwd|pwd)\s*[=:]\s*['\"]([^'\"']{8,})['\"]", ("pa", "pw"), lead=0),
    SecretRule(25, "S3_Bucket_Ref", 2, r"s3://[a-z0-9._-]{3,}|[a-z0-9.-]{3,}\.s3\.amazonaws\.com",
               ("s3",), lead=_LOWER + "-."),
    SecretRule(26, "Azure_Conn", 2,
               r"DefaultEndpointsProtocol=https;AccountName=[^;]+;AccountKey=[^;]{20,}",
               ("defaultendpointsprotocol",), lead=0),
    SecretRule(27, "Internal_IP", 2, r"[0-9./]+", ("10.", "172.", "192.168."),
               keep="^" + _INTERNAL_IP + "$",
               java=r"(?<![./\d])" + _INTERNAL_IP + r"(?![./\d])", lead=0),
    SecretRule(28, "GQL_Endpoint", 2, r"(?i)['\"/](graphql|graphiql|__schema)['\"/]",
               ("graph", "__schema"), lead=1),
    SecretRule(29, "Generic_Credential", 3,
               r"(?i)(credential|creds|login)\s*[=:]\s*['\"]([^'\"]{6,})['\"]",
               ("cred", "login"), lead=0),
    SecretRule(30, "OAuth_Client_ID", 3, r"(?i)client[_-]?id\s*[=:]\s*['\"]([a-zA-Z0-9_-]{8,})['\"]",
               ("client",), lead=0),
    SecretRule(31, "Webhook_URL", 3, r"https://hooks\.(slack|discord)\.com/[^\s\"'<>]{10,}",
               ("https://hooks.",), lead=0),
    SecretRule(32, "Mapbox_Token", 3, r"\bpk\.eyJ[A-Za-z0-9]{20,}\b", ("pk.eyj",), lead=0),
    SecretRule(33, "Algolia_Key", 3,
               r"(?i)algolia[_-]?(api[_-]?key|app[_-]?id)\s*[=:]\s*['\"]([A-Za-z0-9]{8,})['\"]",
               ("algolia",), lead=0),
    # Our additions (the driver corpora hit none of the rules above).
    SecretRule(34, "Generic_Token_Hex", 3, r"(?i)\btoken\s*=\s*\"[0-9a-f]{40}\"", ("token",),
               noise_exempt=True, origin="ours", lead=0),
    SecretRule(35, "IPv4_Literal", 3,
               r"\b((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\b",
               (".",), origin="ours",
               java=r"(?=[0-9])(?<![A-Za-z0-9_])((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}"
                    r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![A-Za-z0-9_])", starts=r"[0-9][0-9.]{6,}"),
    SecretRule(36, "Email_Address", 3, r"\b[A-Za-z0-9_][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
               ("@",), origin="ours", lead=_LOWER + _LOWER.upper() + "._%+-"),
)

# FIXED VALUES: noise patterns, matched case-insensitively against the raw match.
NOISE_HEX = r"[0-9a-f]{32}|[0-9a-f]{64}"
NOISE_OTHER = (r"localhost|127\.0\.0\.|example\.com|test\.com|XXXXXXXX|xxxxxxxx|"
               r"YOUR_|your_|TODO|todo")

# fix: the original clean-up class also removed backslashes and the letter "s"; we strip
# quotes, whitespace, "=", ":" and ";".
MATCH_KEY_STRIP = r"[ \t\n\r\f'\"=:;]"
MATCH_KEY_MIN = 8
CONTEXT_PAD = 60
DIGEST_KEY = "surfacekit:"  # default key of the digests of secrets; callers should give their own

# ---------------------------------------------------------------------------------------
# FIXED VALUES: endpoint call-site shapes (group 1 is the endpoint).
ENDPOINT_PATTERNS = (
    r"""["'`](/(?:api|v\d|rest|rpc|graphql|auth|oauth|admin|user|data|file|upload|payment|webhook)[^"'`\s<>]*)["'`]""",
    r"""(?:fetch|axios\.(?:get|post|put|delete|patch)|http\.(?:get|post))\s*\(\s*["'`]([^"'`\s<>]{5,})["'`]""",
    r"""(?:url|endpoint|path|route|href)\s*[:=]\s*["'`](/[^"'`\s<>]{4,})["'`]""",
    r"""XMLHttpRequest[^;]*?open\s*\(\s*["'][A-Z]+["']\s*,\s*["']([^"']{5,})["']""",
)
ENDPOINT_STATIC = r"\.(png|jpg|jpeg|gif|css|woff|svg|ico|map)(\?|$)"

# FIXED VALUES: endpoint clusters, first match wins in this order, else "other".
# fix: "api" used "//api/"-style alternatives that only matched a double slash; ours use a
# single slash. All words end at a segment boundary so "/opsin" is not "admin".
_SEG_END = r"([/?#.]|$)"
ENDPOINT_CLUSTERS = (
    ("auth", r"(?i)/(login|logout|signin|signout|oauth|token|auth|sso|saml|mfa|2fa|password|reset|forgot)" + _SEG_END),
    ("admin", r"(?i)/(admin|administrator|dashboard|panel|manage|backend|control|cp|internal|staff|ops)" + _SEG_END),
    ("api", r"(?i)/(api|v[0-9]+|rest|rpc|graphql|services?)" + _SEG_END),
    ("upload", r"(?i)/(upload|file|files|media|attachment|asset|import|export)" + _SEG_END),
    ("user", r"(?i)/(user|users|account|accounts|profile|me|member|customer|client)" + _SEG_END),
    ("payment", r"(?i)/(pay|payment|invoice|billing|charge|subscribe|checkout|cart|order)" + _SEG_END),
    ("debug", r"(?i)/(debug|test|dev|staging|config|settings|env|info|health|status|ping|actuator|metrics)" + _SEG_END),
    ("data", r"(?i)/(data|report|reports|export|download|backup|dump|db|database|search)" + _SEG_END),
    ("webhook", r"(?i)/(webhook|callback|notify|hook|event|push|feed)" + _SEG_END),
)
HIGH_VALUE_CLUSTERS = ("auth", "admin", "payment", "upload", "debug", "api")

# FIXED VALUES: cloud storage references in URL and script text.
S3_REFERENCE = r"(?i)s3://[a-z0-9._-]+|[a-z0-9.-]+\.s3\.amazonaws\.com[^\"\s]*"
