"""AGG5's stored statistics: mergeable partial aggregates for each set of input files.

Facts are (metric, key, tier_of) rows. A metric with keys counts distinct keys, one without counts rows.
Partial rows keep, for a set of input files, each metric's keys as 128-bit digests, or the number
of rows; for keys that carry a rank, the least one (a leaked value belongs to its first place, whose
tier decides). Partials of any sets of files merge into the whole: sums, distinct digests, least
ranks. They are committed to a ledger under the digest of their files, so new files alone are
scanned, a retry commits once, and the stats row is made from partials without any corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surfacekit.sources.ledger import Ledger

RANK = "struct<url:string,rule_ord:int,offset:int,tier:int>"
FACTS = ("metric", "key", "rank")
PARTIALS = ("metric", "digest", "rows", "rank")


def fact(df: DataFrame, metric: str, key: str | None = None) -> DataFrame:
    """Rows of ``df`` as facts of one metric: distinct by ``key``, or counted as they are."""
    return df.select(F.lit(metric).alias("metric"), (F.col(key) if key else F.lit(None)).cast("string").alias("key"), F.lit(None).cast(RANK).alias("rank"))


def partial_stats(facts: DataFrame) -> DataFrame:
    """facts -> (metric, digest, rows, rank): one row for each key, or for each metric without keys.
    Partially aggregated before the shuffle, so a hot key sends a row a task."""
    digest = F.when(F.col("key").isNotNull(), F.unhex(F.md5("key"))).alias("digest")
    return facts.groupBy("metric", digest).agg(F.count("*").alias("rows"), F.min("rank").alias("rank"))


def merged(partials: DataFrame, max_tier: int = 2) -> DataFrame:
    """Partials of any sets of files -> (metric, value)."""
    keys = partials.groupBy("metric", "digest").agg(F.sum("rows").alias("rows"), F.min("rank").alias("rank"))
    kept = keys.where("rank is null" + f" or rank.tier <= {int(max_tier)}")
    value = F.sum(F.when(F.col("digest").isNull(), F.col("rows")).otherwise(1))
    return kept.groupBy("metric").agg(value.cast("long").alias("value"))


class StatStore:
    """The partials kept at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.ledger = spark, Ledger(spark, path)

    def covered(self) -> set[str]:
        """The files (as ``file_ids`` names them) that some commit covers."""
        return {f for c in self.ledger.commits() for f in c.name.split("\n")}

    def add(self, files: Sequence[str], facts: Callable[[], DataFrame]) -> bool:
        """Commits the partials of ``files``, unless all of them are covered already."""
        new = sorted(set(files) - self.covered())
        if not new:
            return False
        rows = partial_stats(facts()).withColumn("part", F.concat(F.lit(_digest(new)), F.col("metric"), F.coalesce(F.hex("digest"), F.lit(""))))
        return self.ledger.append_new(rows, "part", name="\n".join(new)) > 0

    def partials(self) -> DataFrame:
        rows = self.ledger.read()
        if rows is None:
            return self.spark.createDataFrame([], f"metric string, digest binary, rows long, rank {RANK}")
        return rows.select(*PARTIALS)


def _digest(files: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(files).encode()).hexdigest()[:16]


def file_ids(spark: SparkSession, path: str) -> dict[str, str]:
    """path -> 'path length time' of every Parquet file of a table: listed, not read."""
    rows = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
            .select("path", "length", "modificationTime").collect())
    return {r["path"]: f"{r['path']} {r['length']} {r['modificationTime']}" for r in rows}
