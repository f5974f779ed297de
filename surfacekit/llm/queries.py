"""Registered queries of this subpackage: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surfacekit.llm import (
    dated_lists,
    decontaminate,
    fill_middle,
    hamming_search,
    html_text,
    language_mixture,
    licences,
    ngram_join,
    packing,
    piece_bpe,
    quality,
    substring_dedup,
    token_alignment,
    url_lists,
)
from surfacekit.llm.common import table

END_ID = 2


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hamming_search.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=85)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_lists.listed(dated_lists.captures(pages), dated_lists.entries(pages))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.identify_languages(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=END_ID)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = piece_bpe.decode_ids(piece_bpe.encode_texts(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents"), seed="1"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_hamming_search, op2_licences, op3_ngram_join, op4_html_text, op5_substring_dedup, op6_decontamination, op7_url_lists,
    op8_language_mixture, op9_quality, op10_packing, op11_token_alignment, op12_byte_bpe, op13_fill_middle)}
ORACLE: dict[str, str] = {"op7_url_lists": dated_lists.ORACLE, "op13_fill_middle": r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), cuts AS (
  SELECT doc_id, text, tokens, len(tokens) AS n, CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4,
    CAST('0x' || h[1:8] AS BIGINT) % (len(tokens) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(tokens) + 1) AS y FROM drawn
), parts AS (
  SELECT doc_id, text, n, array_to_string(tokens[1:least(x, y)], '') AS prefix, array_to_string(tokens[least(x, y) + 1:greatest(x, y)], '') AS middle,
    array_to_string(tokens[greatest(x, y) + 1:], '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
         WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM parts"""}
