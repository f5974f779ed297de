"""Registered queries of the leak scanner: EXT1-EXT5, PRJ10, PRJ11, PRJ15, JN3."""

from __future__ import annotations

from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.functions.text import TOKEN_RUN, display_finding
from surfacekit.operators import secrets as SE
from surfacekit.plans import sqlbits as S
from surfacekit.plans.registry import register
from surfacekit.sources import tables as T

# ---------------------------------------------------------------------------------------
# SQL: corpus


def _tok(col: str) -> str:
    return f"translate(md5({col}), '0123456789', 'ghijklmnop')"


def render_template_sql(template: str) -> str:
    parts, pos = [], 0
    for m in T._PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(S.lit(template[pos:m.start()]))
        name = m.group(1)
        expr = {"K": _tok("host"), "KU": f"upper({_tok('host')})", "P": _tok("page_url"),
                "PU": f"upper({_tok('page_url')})", "N": "CAST(page_id AS VARCHAR)",
                "M": "CAST(page_id % 250 AS VARCHAR)", "O": "split_part(host, '.', 1)"}[name]
        if m.group(2):
            expr = f"substr({expr}, {m.group(2)}, {m.group(3)})"
        parts.append(expr)
        pos = m.end()
    if pos < len(template):
        parts.append(S.lit(template[pos:]))
    return "(" + " || ".join(parts) + ")"


def corpus_cte() -> str:
    snippets = " || chr(10) || ".join(render_template_sql(t) for t in T.SEED_SNIPPETS)
    return f"""
js_pages AS (
  SELECT page_id, url AS page_url, html, {S.host('url')} AS host FROM pages
),
js_corpus AS (
  SELECT {S.scheme('page_url')} || '://' || {S.authority('page_url')} || '/static/js/app-'
         || CAST(page_id AS VARCHAR) || '.js' AS url,
         html || chr(10) || '<script>' || chr(10) || {snippets} || chr(10) || '</script>' || chr(10) AS content
  FROM js_pages
),
doc_corpus AS (
  SELECT 'doc://' || source || '/' || CAST(doc_id AS VARCHAR) AS url, text AS content FROM documents
),
turn_corpus AS (
  SELECT 'conv://' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS url, text AS content FROM conversations
),
corpus AS (SELECT url, content FROM js_corpus UNION ALL SELECT url, content FROM doc_corpus
           UNION ALL SELECT url, content FROM turn_corpus)"""


def rule_meta_cte(rule_set=rules.SECRET_RULES) -> str:
    rows = ", ".join(
        f"({r.ord}, {r.tier}, {S.lit(r.name)}, {'true' if r.noise_exempt else 'false'}, "
        f"{S.lit(r.keep) if r.keep else 'NULL'})" for r in rule_set)
    return f"rule_meta(rule_ord, tier, type, noise_exempt, keep_pat) AS (VALUES {rows})"


def hits_cte(rule_set=rules.SECRET_RULES) -> str:
    per_rule = "\n  UNION ALL ".join(
        f"SELECT url, content, {r.ord} AS rule_ord, regexp_extract_all(content, {S.lit(r.pattern)}) AS m, "
        f"{S.lit(r.pattern)} AS pat FROM corpus" for r in rule_set)
    return f"""{corpus_cte()},
{rule_meta_cte(rule_set)},
hits0 AS (
  {per_rule}
),
hits AS (
  SELECT url, content, rule_ord, m, string_split_regex(content, pat) AS g FROM hits0 WHERE len(m) > 0
),
hit_rows AS (
  SELECT url, content, rule_ord, m, g, unnest(range(len(m))) AS idx FROM hits
),
matches0 AS (
  SELECT h.url, h.content, h.rule_ord, h.idx, h.m[h.idx + 1] AS raw,
    CAST(list_sum(list_transform(h.g[1:h.idx + 1], lambda x: length(x)))
      + coalesce(list_sum(list_transform(h.m[1:h.idx], lambda x: length(x))), 0) AS BIGINT) AS "offset",
    r.tier, r.type, r.noise_exempt, r.keep_pat
  FROM hit_rows h JOIN rule_meta r USING (rule_ord)
),
matches AS (
  SELECT * EXCLUDE (idx), row_number() OVER (PARTITION BY url, rule_ord ORDER BY "offset") - 1 AS idx
  FROM matches0 WHERE keep_pat IS NULL OR regexp_matches(raw, keep_pat)
),
clean_matches AS (
  SELECT *, regexp_replace(raw, {S.lit(rules.MATCH_KEY_STRIP)}, '', 'g') AS clean FROM matches
  WHERE NOT (regexp_matches(raw, {S.lit('(?i)' + rules.NOISE_OTHER)})
             OR (NOT noise_exempt AND regexp_matches(raw, {S.lit('(?i)' + rules.NOISE_HEX)})))
),
keyed AS (SELECT * FROM clean_matches WHERE length(clean) >= {rules.MATCH_KEY_MIN}),
spans AS (
  SELECT k.url, k.rule_ord, k."offset" AS o, k.idx, any_value(k.content) AS content, any_value(k.raw) AS raw,
    list({{'s': m."offset", 'e': m."offset" + length(m.raw)}}) AS covered
  FROM keyed k JOIN matches m ON m.url = k.url AND m."offset" < k."offset" + length(k.raw) + 60
    AND m."offset" + length(m.raw) > k."offset" - 60
  GROUP BY k.url, k.rule_ord, k."offset", k.idx
),
windows AS (
  SELECT url, rule_ord, o, idx, array_to_string(list_transform(
    range(greatest(0, o - 60), least(length(content), o + length(raw) + 60)),
    lambda p: CASE WHEN len(list_filter(covered, lambda c: c.s <= p AND p < c.e)) > 0 THEN '*' ELSE substr(content, p + 1, 1) END), '') AS win
  FROM spans
),
secret_rows AS (
  SELECT url, rule_ord, tier, type, "offset", idx, {digest('clean')} AS match_key, {mask('clean')} AS match,
    CASE WHEN length(ctx) > 200 THEN substr(ctx, 1, 100) || '...' || right(ctx, 60) ELSE ctx END AS context
  FROM (
    SELECT k.*, regexp_replace(replace(regexp_replace(w.win, {S.lit(TOKEN_RUN)}, '\\1***', 'g'), chr(10), ' '),
                               '^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$', '', 'g') AS ctx
    FROM keyed k JOIN windows w ON w.url = k.url AND w.rule_ord = k.rule_ord AND w.o = k."offset" AND w.idx = k.idx
  )
),
dedup AS (
  SELECT tier, type, rule_ord, url, "offset", match, match_key, context FROM (
    SELECT *, row_number() OVER (PARTITION BY match_key ORDER BY url, rule_ord, "offset") AS rn
    FROM secret_rows) WHERE rn = 1
)"""


def digest(expr: str) -> str:
    return f"sha256({S.lit(rules.DIGEST_KEY)} || {expr})"


def mask(expr: str) -> str:
    return f"(substr({expr}, 1, 4) || '***' || substr({digest(expr)}, 1, 8))"


_W = S.with_(hits_cte())


def _scan(spark, d):
    return SE.scan_secrets(T.secret_corpus(spark, d))


@register("ext1_scan_secrets", _W + """
SELECT url, rule_ord, idx, "offset", length(raw) AS match_len, md5(raw) AS raw_hash FROM matches""")
def q_ext1(spark, d):
    return _scan(spark, d).select("url", "rule_ord", "idx", "offset",
                                  F.length("raw").alias("match_len"), F.md5("raw").alias("raw_hash"))


# Rules of the caller's own, beside the library's: (name, pattern, tier, anchors).
OWN_RULES = (
    ("Contact address", r"(?i)\b[a-z0-9._%+-]{1,64}@[a-z0-9-]{1,63}(?:\.[a-z0-9-]{1,63}){1,4}\b", 3, ("@",)),
    ("Numbered id", r"(?i)\b[a-z]{2,12}[-_][0-9]{1,9}\b", 4),
    ("Data attribute", r"(?i)\bdata-[a-z-]{1,30}=[\"'][^\"'<>]{1,80}", 4, ("data-",)),
    ("Port in a link", r"(?i)https?://[a-z0-9.-]{1,100}:[0-9]{2,5}\b", 2, ("http://", "https://")),
)
_ALL_RULES = SE.with_user_rules(OWN_RULES)
_FIRST_OWN = len(rules.SECRET_RULES)


@register("ext1_user_rules", S.with_(hits_cte(_ALL_RULES[_FIRST_OWN:])) + """
SELECT url, tier, type, idx, "offset", length(raw) AS match_len, md5(raw) AS raw_hash FROM matches""")
def q_ext1_user(spark, d):
    """EXT1 with rules of the caller's own: the library's and theirs run in one pass, theirs are shown."""
    found = SE.scan_secrets(T.secret_corpus(spark, d), _ALL_RULES)
    own = [r.name for r in _ALL_RULES[_FIRST_OWN:]]
    return found.where(F.col("type").isin(own)).select(
        "url", "tier", "type", "idx", "offset", F.length("raw").alias("match_len"), F.md5("raw").alias("raw_hash"))


@register("ext2_drop_noise", _W + """SELECT url, rule_ord, idx, "offset" FROM clean_matches""")
def q_ext2(spark, d):
    return SE.drop_noise(_scan(spark, d)).select("url", "rule_ord", "idx", "offset")


@register("ext3_match_offsets", _W + """
SELECT url, rule_ord, idx, "offset", substr(content, "offset" + 1, length(raw)) = raw AS sliced_ok
FROM matches""")
def q_ext3(spark, d):
    m = _scan(spark, d).join(T.secret_corpus(spark, d), "url")
    return m.select("url", "rule_ord", "idx", "offset",
                    (F.substring("content", F.col("offset") + 1, F.length("raw")) == F.col("raw"))
                    .alias("sliced_ok"))


@register("prj10_match_key", _W + """
SELECT url, rule_ord, idx, sha256(clean) AS match_key, length(clean) AS key_len FROM keyed""")
def q_prj10(spark, d):
    return SE.keyed(_scan(spark, d)).select(
        "url", "rule_ord", "idx", F.sha2("clean", 256).alias("match_key"),
        F.length("clean").alias("key_len"))


@register("prj11_context_window", _W + "SELECT url, rule_ord, idx, context FROM secret_rows")
def q_prj11(spark, d):
    return SE.findings(_scan(spark, d)).select("url", "rule_ord", "idx", "context")


@register("prj15_mask_secret", _W + "SELECT url, rule_ord, idx, match FROM secret_rows")
def q_prj15(spark, d):
    return SE.findings(_scan(spark, d)).select("url", "rule_ord", "idx", "match")


@register("ext4_dedup_secrets", _W + "SELECT * FROM dedup")
def q_ext4(spark, d):
    return SE.secret_findings(T.secret_corpus(spark, d))


@register("prj12_display_finding", _W + """
SELECT url, rule_ord, "offset", '[' || CAST(tier AS VARCHAR) || '] ' || type || ' | ' || url || ' | ' || match AS line FROM dedup""")
def q_prj12_finding(spark, d):
    f = SE.secret_findings(T.secret_corpus(spark, d))
    return f.select("url", "rule_ord", "offset", display_finding(F.col("tier"), F.col("type"), F.col("url"), F.col("match")).alias("line"))


@register("ext5_rank_findings", _W + "SELECT * FROM dedup WHERE tier <= 2")
def q_ext5(spark, d):
    return SE.rank_findings(SE.secret_findings(T.secret_corpus(spark, d)), max_tier=2)


@register("jn3_merge_second_scanner", _W + f""",
extra AS (
  SELECT url, regexp_replace(unnest(regexp_extract_all(content, {S.lit(SE.SECOND_SCANNER)})),
                             {S.lit(rules.MATCH_KEY_STRIP)}, '', 'g') AS clean FROM corpus
),
fresh AS (SELECT url, clean FROM extra WHERE length(clean) > 2 AND clean NOT IN (SELECT clean FROM keyed))
SELECT min(url) AS url, {mask('clean')} AS match, {digest('clean')} AS match_key FROM fresh GROUP BY clean""")
def q_jn3(spark, d):
    corpus = T.secret_corpus(spark, d)
    existing = SE.keyed(SE.scan_secrets(corpus))
    return SE.merge_second_scanner(existing, SE.second_scanner_lines(corpus))
