"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, through Spark's reader (the folder may be in any store Spark reads)."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lowers the session's Arrow batches to ``rows`` rows: here a row can hold a whole document
    or its n-grams, and a batch is in memory at once on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint directory. Only a local session without that
    setting (tests) gets a temporary directory of its own; on a cluster it is an error."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="surfacekit-llm-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later steps reread these files
    instead of computing it again, also after an executor is lost."""
    path = scratch(df.sparkSession)
    small_batches(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest_hashes(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``: those with the smallest hashes of ``key``. Only hashes are
    sorted; the rows themselves are filtered where they are."""
    h = F.xxhash64(key)
    cut = df.select(h.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.where(h <= (cut if cut is not None else 0)).limit(rows)


BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored side of a join, of a few longs a row: marked for broadcast if it has at most
    ``rows`` rows, which saves shuffling the texts on the other side; beyond that Spark joins by
    shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def worker_cache(key: str, make: Callable):
    """A value made once per Python worker and kept between its tasks."""
    held = sys.modules.setdefault("_surfacekit_llm_cache", types.ModuleType("_surfacekit_llm_cache"))
    if not hasattr(held, key):
        setattr(held, key, make())
    return getattr(held, key)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """True on the fold that is never learned from: crc32 of the id as text, modulo ``folds``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def text_chunks(values: list, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of ``values`` (bytes or str or None) of about ``limit`` bytes each, so that numpy
    temporaries stay small; a value above the limit has a range of its own."""
    start = total = 0
    for i, v in enumerate(values):
        n = len(v) if v else 0
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(values):
        yield start, len(values)
