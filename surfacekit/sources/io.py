"""Sources and sinks (SRC1-SRC5, SNK1-SNK4).

Readers take explicit schemas (no inference passes over the data); sinks never overwrite
with empty output and write partitioned Parquet, so the "master file" is simply the
unpartitioned read of the same folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def read_lines(spark: SparkSession, path: str, source: str | None = None) -> DataFrame:
    """SRC1: non-blank lines, BOM stripped, trimmed; ``source`` = given name or file name.
    Undecodable bytes are replaced by the text reader, never fatal."""
    df = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_file"))
    line = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), r"^\s+|\s+$", "")
    src = F.lit(source) if source else F.col("_file")
    return df.select(line.alias("line"), src.alias("source")).where(F.col("line") != "")


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC2: JSON Lines with an explicit schema; blank and malformed lines are dropped, the
    same lines whichever columns are used."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    row = F.from_json("value", _with_rest(kind), _PERMISSIVE)
    lines = spark.read.text(path).where(F.trim("value") != "").select(row.alias("r"))
    return lines.where("r is not null and r._malformed is null").select(*[F.col("r")[f.name].alias(f.name) for f in kind.fields])


_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}


def _with_rest(kind: StructType) -> StructType:
    return StructType([*kind.fields, StructField("_malformed", StringType())])


def json_files(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """SRC3: whole-document JSON, (documents, unparsed). A file holds one object, or one array of
    objects; documents(file, pos, <schema columns>) has a row for each object, with its place in the
    file; unparsed(file, n_chars) names the files that are neither, so that none is lost silently.
    Files of white space alone are unparsed; an empty array gives no rows and counts as parsed."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    one = F.from_json("value", _with_rest(kind), _PERMISSIVE)
    many = F.from_json("value", ArrayType(kind), {"mode": "PERMISSIVE"})
    is_list = F.ltrim(F.regexp_replace("value", r"^[\s﻿]+", "")).startswith("[")
    parsed = files.select("file", F.length("value").alias("n_chars"), is_list.alias("is_list"), F.when(is_list, many).alias("many"), F.when(~is_list, one).alias("one"))
    good = F.when(F.col("is_list"), F.col("many").isNotNull()).otherwise(F.col("one").isNotNull() & F.col("one._malformed").isNull())
    fields = F.struct(*[F.col("one")[f.name].alias(f.name) for f in kind.fields])
    items = F.when(F.col("is_list"), F.col("many")).otherwise(F.array(fields))
    documents = parsed.where(good).select("file", F.posexplode(items).alias("pos", "doc")).select("file", "pos", *[F.col("doc")[f.name].alias(f.name) for f in kind.fields])
    return documents, parsed.where(~F.coalesce(good, F.lit(False))).select("file", "n_chars")


def read_json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC3: the documents of ``json_files`` alone."""
    return json_files(spark, path, schema)[0].drop("file", "pos")


def read_csv_results(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """SRC4: CSV result files with a header row."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def union_sources(sources: Mapping[str, DataFrame], col: str = "value") -> DataFrame:
    """SRC5: union of raw producers with their name as ``source`` (distinct is SET1).
    Only raw producer outputs belong here: derived outputs must never be merged back."""
    out = None
    for name, df in sources.items():
        part = df.select(F.col(col).alias(col), F.lit(name).alias("source"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no sources")
    return out


def write_nonempty(df: DataFrame, path: str, mode: str = "overwrite",
                   partition_by: list[str] | None = None) -> bool:
    """SNK1: write only when there is content (never replace data with an empty result).
    Returns whether anything was written. The plan runs once: it is written to a folder beside
    the target and counted meanwhile; only rows take the target's place. A run that fails leaves the
    target as it was."""
    spark, seen = df.sparkSession, Observation()
    target = path.rstrip("/")
    draft = f"{target}.draft-{uuid.uuid4().hex[:12]}"
    w = df.observe(seen, F.count(F.lit(1)).alias("n")).write
    w = w.partitionBy(*partition_by) if partition_by else w
    w.parquet(draft)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(target).getFileSystem(conf)
    some = seen.get["n"] > 0
    if some and mode == "append" and fs.exists(at(target)):
        rows = spark.read.schema(df.schema).parquet(draft).write.mode("append")
        (rows.partitionBy(*partition_by) if partition_by else rows).parquet(target)
    elif some:
        if fs.exists(at(target)):
            if mode != "overwrite":
                fs.delete(at(draft), True)
                raise ValueError(f"{path} exists")
            fs.delete(at(target), True)
        fs.mkdirs(at(target).getParent())
        if not fs.rename(at(draft), at(target)):
            raise OSError(f"{draft} could not take the place of {path}")
    fs.delete(at(draft), True)
    return some


def append_new(spark: SparkSession, incoming: DataFrame, key: str, sink: str) -> int:
    """SNK2 on a plain Parquet folder: append only rows whose key is not yet in it (and once each);
    returns the number of rows appended. For one writer at a time; ``ledger.Ledger`` has a commit protocol
    for several and for retries."""
    from surfacekit.operators.inventory import append_candidates
    try:
        existing = spark.read.parquet(sink)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        existing = None  # no folder, or one without files: an empty sink
    new = incoming.dropDuplicates([key]) if existing is None else append_candidates(existing, incoming, key)
    if existing is not None:
        # the result depends on the folder we append to: cut the lineage first (reliable
        # checkpoint in the shared checkpoint folder) so the write never re-reads the sink
        from surfacekit.session import checkpoint_dir
        checkpoint_dir(spark)
        new = new.checkpoint(eager=True)
    seen = Observation()
    new.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(sink)
    return seen.get["n"]


def write_by_class(df: DataFrame, path: str, class_col: str = "vuln_class", mode: str = "append") -> None:
    """SNK3: per-class outputs and the master in one write: partitioned by class; reading
    the folder unpartitioned is the master."""
    df.write.mode(mode).partitionBy(class_col).parquet(path)


def count_rows(df: DataFrame | None, line_col: str | None = None) -> DataFrame:
    """SNK4: row (or non-blank line) count as a one-row DataFrame; 0 when missing."""
    if df is None:
        from pyspark.sql import SparkSession as _S
        return _S.active().range(1).select(F.lit(0).cast("bigint").alias("n_rows"))
    if line_col:
        df = df.where(F.trim(F.col(line_col)) != "")
    return df.agg(F.count("*").cast("bigint").alias("n_rows"))
