"""Secret / leak scanning engine (EXT1-EXT5, PRJ10, PRJ11, PRJ15, AGG10, JN3).

Plan shape (all narrow until the dedup aggregate):

1. one Arrow-batched pass over the corpus: one automaton finds the literal anchors of all rules
   in the lower-cased text. A rule that says how far before an anchor a match may begin is tried
   there alone; any other rule with an anchor has one ``finditer`` -- linear in
   the text and its matches, however many rules the user adds. Each match leaves
   with its offset and its context; the text itself goes no further. In the context every
   character that any match of any rule covers is already replaced by ``*``, so a context
   never shows the match or a neighbouring one;
2. noise filter on the raw match, clean-up to the match key, masking -- built-in functions;
3. dedup by the digest of the whole key (``min`` of a struct ordered by url, rule, offset):
   partial aggregation runs map-side, so a hot key (a placeholder token in a third of all
   documents) sends one row per map task, not all its rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surfacekit import rules
from surfacekit.functions.text import mask_secret, tidy_context

Rules = Sequence[rules.SecretRule]

MATCHES = ("url string, rule_ord int, tier int, type string, noise_exempt boolean, idx int, offset int, "
           "raw string, window string")


def with_user_rules(extra: Sequence[tuple], base: Rules = rules.SECRET_RULES) -> list[rules.SecretRule]:
    """``base`` and then the caller's rules, given as (name, pattern, tier) or (name, pattern, tier, anchors).

    The patterns are portable ones (no look-around, no back references, ``\\b`` of ASCII words); a
    pattern that does not compile or that matches the empty text, a name that is taken and an
    anchor that is not lower-case are errors here, before any job runs. Anchors are literals of which
    every match holds one, in lower case; a rule without anchors reads every text."""
    taken, out = {r.name for r in base}, list(base)
    first = max((r.ord for r in base), default=0) + 1
    for k, (name, pattern, tier, *more) in enumerate(extra):
        anchors = tuple(more[0]) if more else ()
        if name in taken:
            raise ValueError(f"rule {name!r}: the name is taken")
        if re.search(r"\(\?(?:<?[=!]|P=)|\\[1-9]", pattern):
            raise ValueError(f"rule {name!r}: look-around and back references are not portable")
        try:
            empty = re.compile(pattern, re.A).search("")
        except re.error as e:
            raise ValueError(f"rule {name!r}: {e}") from e
        if empty:
            raise ValueError(f"rule {name!r}: the pattern matches the empty text")
        if any(not a or a != a.lower() for a in anchors):
            raise ValueError(f"rule {name!r}: anchors are lower-case literals")
        taken.add(name)
        out.append(rules.SecretRule(first + k, name, tier, pattern, anchors, origin="user"))
    return out


def _windows(text: str, spans: list[tuple[int, int]], pad: int) -> Iterator[str]:
    """For each span (sorted by start), the text ``pad`` characters around it with every
    covered character as ``*``. Covered ranges are merged once, so this is linear."""
    merged: list[list[int]] = []
    for a, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    first = 0
    for a, b in spans:
        lo, hi = max(0, a - pad), min(len(text), b + pad)
        while merged[first][1] <= lo:
            first += 1
        out, at, k = [], lo, first
        while k < len(merged) and merged[k][0] < hi:
            x, y = max(lo, merged[k][0]), min(hi, merged[k][1])
            out += [text[at:x], "*" * (y - x)]
            at, k = y, k + 1
        yield "".join(out) + text[at:hi]


def _anchor_automaton(rule_set: Rules):
    """One automaton over all anchors of all rules: each anchor's value is its length, a bit mask of
    its rules, and those of them that are tried where the anchor is."""
    import ahocorasick

    masks: dict[str, int] = {}
    for k, r in enumerate(rule_set):
        for anchor in r.anchors or ():
            masks[anchor] = masks.get(anchor, 0) | 1 << k
    # an anchor inside another one never shadows it: the automaton reports both
    automaton = ahocorasick.Automaton()
    for anchor, mask in masks.items():
        near = tuple(k for k, r in enumerate(rule_set) if mask >> k & 1 and r.lead is not None)
        automaton.add_word(anchor, (len(anchor), mask, near))
    if masks:
        automaton.make_automaton()
    return automaton if masks else None


def _near(pattern: re.Pattern, text: str, anchors: list[int], lead: int | str) -> Iterator[re.Match]:
    """The matches of ``finditer``, given that each begins at most ``lead`` characters (or any number
    of characters out of ``lead``) before an anchor. No place is tried twice."""
    at = 0
    for a in sorted(anchors):
        first = a
        if isinstance(lead, int):
            first = max(at, a - lead)
        else:
            while first > at and text[first - 1] in lead:
                first -= 1
        at = max(at, first)
        while at <= a:
            m = pattern.match(text, at)
            if m:
                yield m
            at = m.end() if m else at + 1


def _inside(pattern: re.Pattern, text: str, starts: re.Pattern) -> Iterator[re.Match]:
    """The matches of ``finditer``, given that each begins inside a match of ``starts``."""
    at = 0
    for span in starts.finditer(text):
        at = max(at, span.start())
        while at < span.end():
            m = pattern.match(text, at)
            if m:
                yield m
            at = m.end() if m else at + 1


def _scanner(rule_set: Rules, pad: int | None):
    rule_list = list(rule_set)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [(r.ord, r.tier, r.name, r.noise_exempt, re.compile(r.pattern, re.A), re.compile(r.keep, re.A) if r.keep else None) for r in rule_list]
        # the look-around form stands for the pattern and its post-filter
        tried = [re.compile(r.java or r.pattern, re.A) for r in rule_list]
        starts = [re.compile(r.starts, re.A) if r.starts else None for r in rule_list]
        automaton = _anchor_automaton(rule_list)
        always = sum(1 << k for k, r in enumerate(rule_list) if not r.anchors)

        def matches(text: str) -> Iterator[tuple[int, list[re.Match]]]:
            """The matches of each rule one of whose anchors occurs, from one pass of the text."""
            low, mask, near = text.lower(), always, {}
            if automaton is not None:
                for end, (n, own, located) in automaton.iter(low):
                    mask |= own
                    for k in located:
                        near.setdefault(k, []).append(end - n + 1)
            aligned = len(low) == len(text)  # a letter whose small form is two moves the places
            for k, r in enumerate(rule_list):
                if not mask >> k & 1:
                    continue
                pattern, keep = ready[k][4:]
                if k in near and aligned:
                    yield k, list(_near(tried[k], text, near[k], r.lead))
                elif starts[k]:
                    yield k, list(_inside(tried[k], text, starts[k]))
                else:
                    yield k, [m for m in pattern.finditer(text) if m[0] and (keep is None or keep.search(m[0]))]

        for batch in batches:
            rows: list[tuple] = []
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                for url, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if not text:
                        continue
                    found = []
                    for k, hits in matches(text):
                        ord_, tier, name, exempt, *_ = ready[k]
                        found += [(m.start(), m.end(), ord_, tier, name, exempt, i, m[0]) for i, m in enumerate(hits)]
                    found.sort(key=lambda x: x[:3])
                    spans = [x[:2] for x in found]
                    for x, window in zip(found, repeat(None) if pad is None else _windows(text, spans, pad)):
                        rows.append((url, *x[2:7], x[0], x[7], window))
                    if len(rows) > 10_000:
                        yield _batch(rows)
                        rows = []
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.string())
    names = [x.split()[0] for x in MATCHES.split(", ")]
    cols = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)


def scan_secrets(corpus: DataFrame, rule_set: Rules = rules.SECRET_RULES,
                 id_col: str = "url", text_col: str = "content", windows: bool = True) -> DataFrame:
    """EXT1 + EXT3: every match of every rule in every document, with its offset and its
    redacted surroundings: (url, rule_ord, tier, type, noise_exempt, idx, offset, raw, window).
    Without ``windows`` the surroundings are null."""
    return corpus.select(F.col(id_col), F.col(text_col)).mapInArrow(
        _scanner(rule_set, rules.CONTEXT_PAD if windows else None), MATCHES)


def noise_expr(raw: Column, exempt: Column) -> Column:
    other = raw.rlike("(?i)" + rules.NOISE_OTHER)
    hexrun = raw.rlike("(?i)" + rules.NOISE_HEX)
    return other | (~exempt & hexrun)


def drop_noise(matches: DataFrame) -> DataFrame:
    """EXT2: drop placeholder / local / example / hex-run matches (before dedup)."""
    return matches.where(~noise_expr(F.col("raw"), F.col("noise_exempt")))


def keyed(matches: DataFrame) -> DataFrame:
    """EXT2 + PRJ10: noise-free matches with the cleaned key (>= 8 characters)."""
    key = F.regexp_replace(F.col("raw"), rules.MATCH_KEY_STRIP, "")
    return (drop_noise(matches).withColumn("clean", key)
            .where(F.length("clean") >= rules.MATCH_KEY_MIN))


def findings(matches: DataFrame, key: str = rules.DIGEST_KEY) -> DataFrame:
    """PRJ10 + PRJ11 + PRJ15 on noise-free matches: keyed digest of the whole cleaned match,
    masked match, context. Give a ``key`` of your own: short secrets can be guessed from
    digests whose key is known."""
    return keyed(matches).select(
        "url", "rule_ord", "tier", "type", "offset", "idx",
        F.sha2(F.concat(F.lit(key), F.col("clean")), 256).alias("match_key"),
        mask_secret(F.col("clean"), key).alias("match"), tidy_context("window").alias("context"))


def dedup_secrets(f: DataFrame) -> DataFrame:
    """EXT4: one finding per match key, global and deterministic: first url, then first
    rule, then first offset; partial aggregation before the shuffle."""
    best = F.min(F.struct("url", "rule_ord", "offset", "tier", "type", "match", "context"))
    return (f.groupBy("match_key").agg(best.alias("b"))
            .select(F.col("b.tier").alias("tier"), F.col("b.type").alias("type"),
                    F.col("b.rule_ord").alias("rule_ord"), F.col("b.url").alias("url"),
                    F.col("b.offset").alias("offset"), F.col("b.match").alias("match"),
                    "match_key", F.col("b.context").alias("context")))


def secret_findings(corpus: DataFrame, rule_set: Rules = rules.SECRET_RULES,
                    id_col: str = "url", text_col: str = "content") -> DataFrame:
    """EXT1 -> EXT2 -> PRJ10/11/15 -> EXT4."""
    return dedup_secrets(findings(scan_secrets(corpus, rule_set, id_col, text_col)))


def count_secrets(corpus: DataFrame, max_tier: int = 2) -> DataFrame:
    """How many deduplicated findings have a tier up to ``max_tier`` (secrets_found), without
    masks, contexts or texts: one row per key and task is shuffled."""
    first = F.min(F.struct("url", "rule_ord", "offset", "tier")).alias("b")
    keys = keyed(scan_secrets(corpus, windows=False)).groupBy(F.sha2("clean", 256).alias("key")).agg(first)
    return keys.where(F.col("b.tier") <= max_tier).agg(F.count("*").alias("secrets_found"))


def rank_findings(f: DataFrame, max_tier: int | None = 2) -> DataFrame:
    """EXT5: tier order (stable by url, rule, offset); tiers <= ``max_tier`` are exported.
    A range-partitioned sort, never a single-partition global window."""
    out = f if max_tier is None else f.where(F.col("tier") <= max_tier)
    return out.orderBy("tier", "url", "rule_ord", "offset")


def secret_summary(f: DataFrame, endpoints: DataFrame | None = None) -> DataFrame:
    """AGG10: findings per tier, endpoints per cluster, number of files with findings.
    Long form (section, name, value)."""
    parts = [f.groupBy("tier").count().select(F.lit("tier").alias("section"),
                                              F.col("tier").cast("string").alias("name"),
                                              F.col("count").alias("value")),
             f.agg(F.countDistinct("url").alias("value")).select(
                 F.lit("files").alias("section"), F.lit("with_findings").alias("name"), "value")]
    if endpoints is not None:
        parts.append(endpoints.groupBy("cluster").count().select(
            F.lit("endpoints").alias("section"), F.col("cluster").alias("name"),
            F.col("count").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# A second scanner's output: generic key-like assignments (its own rule, not ours).
SECOND_SCANNER = r"""(?i)(key|token|secret|passw(or)?d)[a-z_]*[ \t]*[=:][ \t]*["'][^"'\n]{8,}["']"""


def second_scanner_lines(corpus: DataFrame, id_col: str = "url",
                         text_col: str = "content") -> DataFrame:
    return corpus.select(F.col(id_col).alias("url"), F.explode(
        F.regexp_extract_all(F.col(text_col), F.lit(SECOND_SCANNER), 0)).alias("raw"))


def merge_second_scanner(existing: DataFrame, extra: DataFrame, key: str = rules.DIGEST_KEY) -> DataFrame:
    """JN3: keep lines of ``extra`` whose cleaned value is not that of an existing finding,
    one per value (anti join on the whole value + dedup)."""
    clean = F.regexp_replace(F.col("raw"), rules.MATCH_KEY_STRIP, "")
    e = extra.select("url", clean.alias("clean")).where(F.length("clean") > 2)
    fresh = e.join(existing.select("clean").distinct(), "clean", "left_anti")
    return fresh.groupBy("clean").agg(F.min("url").alias("url")).select(
        "url", mask_secret("clean", key).alias("match"), F.sha2(F.concat(F.lit(key), F.col("clean")), 256).alias("match_key"))
