"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage works on all rows its predecessor kept and takes (spark, docs, sf_dir). All but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surfacekit.llm import decontaminate, ngram_join, packing, quality, substring_dedup
from surfacekit.llm.common import scratch, small_side, stored, table
from surfacekit.llm.queries import END_ID, tokenizer_path


KEY = "key of id and text"


def _keyed(docs: DataFrame) -> DataFrame:
    """Decisions go by rows, not by ids: rows of equal id and text have one key, any others two."""
    return docs.withColumn(KEY, F.xxhash64(F.struct("doc_id", "text")))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose keys are not in ``gone``."""
    return _keyed(docs).join(small_side(stored(gone.select(KEY).distinct())), KEY, "left_anti").select(docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects (predicted 0) go, each by its own text. Null and empty
    texts are scored like any others; repeated rows go or stay together; an empty table gives
    none; other columns, whatever their names, are carried and not used."""
    scored = quality.score_quality(_keyed(docs).select("doc_id", "text", KEY), table(spark, sf_dir, "labels"), carry=(KEY,))
    return _without(docs, scored.where("predicted = 0"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more) the row with the
    least id stays, once (null ids come last, ties go by the key). Documents without words are in
    no group and all stay. An empty table gives none; other columns are carried and not used."""
    rows = _keyed(docs)
    grouped = stored(ngram_join.near_duplicates(rows.select(F.col(KEY).alias("doc_id"), "text"), n=5, percent=80))
    members = grouped.where("n_shingles > 0").groupBy(F.col("doc_id").alias(KEY), "component_id").agg(F.count("*").alias("copies"))
    ids = rows.select(KEY, "doc_id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", KEY)
    members = stored(members.join(ids, KEY))
    first = members.groupBy("component_id").agg(F.min_by(KEY, order).alias(KEY))
    others = members.join(first, ["component_id", KEY], "left_anti")
    kept = _without(docs, others)
    repeated = stored(members.where("copies > 1").join(first.select(KEY), KEY, "left_semi").select(KEY))
    if repeated.isEmpty():
        return kept
    again = rows.join(small_side(repeated), KEY, "left_semi").dropDuplicates([KEY]).select(docs.columns)
    return _without(kept, repeated).unionByName(again)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a 50-word window that also starts elsewhere, in the same or another row, are
    taken out of the texts; a text that loses words is its kept words joined by one blank, and n_chars is
    counted anew. Null and empty texts stay; repeated rows take out each other's windows; an
    empty table gives none; other columns keep their values, whatever their names."""
    own = {c: f"given {c}" for c in docs.columns if c != "text"}
    out = substring_dedup.remove_repeats(docs.withColumnsRenamed(own), window=50)
    back = [F.col(own.get(c, c)).alias(c) for c in docs.columns]
    out = out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else b for c, b in zip(docs.columns, back)])
    return out


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, each by its own text. Null and empty texts hold
    none; repeated rows go together; an empty table gives none; other columns are carried and not used."""
    rows = _keyed(docs).select(F.col(KEY).alias("doc_id"), "text")
    found = decontaminate.contaminated(rows, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select(F.col("doc_id").alias(KEY)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens. Null and empty texts hold the end id alone; repeated rows are
    packed each; an empty table gives none; other columns are not used."""
    return packing.pack_documents(docs, tokenizer_path(), end_id=END_ID)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

#: Learned weights, edit distances and token ids have no SQL form; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
