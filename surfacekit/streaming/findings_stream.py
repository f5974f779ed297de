"""Structured Streaming jobs (STR1-STR7).

The original processes chunks by hand, keeps a seen-set and a chunk index to resume. Here:
a file source is the chunking, the checkpoint folder of a *named* job is the resume state (offsets
and keyed state), sinks are exactly-once file sinks or idempotent ``foreachBatch`` writers keyed by
batch id, and ``trigger(availableNow=True)`` processes everything present and stops. A job started
again under its name goes on where it stopped: no row twice, none lost. All state and outputs live
under the shared checkpoint folder (``spark.checkpoint.dir``), so a lost executor or a restarted
driver resumes, never redoes. Keyed state is kept in RocksDB with changelog checkpoints: what a
batch costs grows with the batch, not with what was seen before.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surfacekit.operators.classify import severity_of
from surfacekit.operators.filters import DEFAULT_SEVERITIES
from surfacekit.session import checkpoint_dir

#: Part of every job's folder: a job whose state has another form begins anew.
STATE_FORM = "1"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def job_dir(spark: SparkSession, name: str, *inputs: str) -> str:
    """The folder of the job ``name`` over ``inputs`` (paths): the same at every start, so that the
    job resumes. Give a job another name to run it from the beginning."""
    digest = hashlib.sha256("\n".join((STATE_FORM, name, *inputs)).encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{digest}"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """While a stream is started (it takes a copy of the settings), its state store is the one above;
    the session's own settings are as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k, v in STATE_STORE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """A given table, a file or a folder of files, as a stream of its own files: nothing is copied
    first. The last letter stands in brackets since the source wants a pattern for a single file;
    it matches this name only."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", True)
            .parquet(f"{path[:-1]}[{path[-1]}]"))


def stream_findings(spark: SparkSession, path: str, schema, files_per_trigger: int | None = 1) -> DataFrame:
    """STR1: chunked, resumable stream over arriving finding files in a folder (and its sub-folders).
    Without ``files_per_trigger`` a batch takes all that has arrived."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def event_time(ts: str) -> Column:
    """Instant for a wall-clock TIMESTAMP_NTZ column read as UTC, independent of the
    session time zone (watermarks need TIMESTAMP)."""
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return F.timestamp_micros(micros)


def stream_dedup(stream: DataFrame, key: str = "finding", watermark: str | None = None,
                 ts_col: str = "event_ts") -> DataFrame:
    """STR2: cross-chunk dedup by exact line. Exact global dedup keeps one key per line in
    the state store (grows with distinct lines); with ``watermark`` the state is bounded
    and duplicates are only caught within the watermark delay."""
    if watermark:
        return stream.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def first_seen(stream: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """STR2 / STR3 as keyed state: for each key of a batch its first row ever (by batch, then by
    ``order``), with ``_new`` where that is of this batch. A streaming aggregate, so a hot line
    sends one row a task to the shuffle. Each row carries its batch's time, which a replayed
    batch keeps: a key is new in a batch if its first and last times are the same."""
    rest = [c for c in stream.columns if c != key]
    arrived = stream.withColumn("_arrived", F.current_timestamp())
    first = F.min_by(F.struct(*rest), F.struct("_arrived", *order)) if rest else F.lit(None)
    state = arrived.groupBy(key).agg(first.alias("_first"), F.min("_arrived").alias("_since"), F.max("_arrived").alias("_last"))
    return state.select(key, *[F.col("_first")[c].alias(c) for c in rest], (F.col("_since") == F.col("_last")).alias("_new"))


def start_distinct(df: DataFrame, key: str, out: str, ckpt: str, partition_by: str | None = None, order: Sequence[str] = ()):
    """STR2 / STR3: the first row of each key, once, in the folder of the batch that brought it (in
    per-class folders there when ``partition_by``). The sink is never read; a replayed batch
    replaces its own folder only; a batch without new rows writes none."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.where("_new").drop("_new").write.mode("overwrite")
        (w.partitionBy(partition_by) if partition_by else w).parquet(f"{out}/batch={batch_id}")

    with state_store(df.sparkSession):
        return (first_seen(df, key, order).writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
                .outputMode("update").trigger(availableNow=True).start())


def start_append(df: DataFrame, out: str, ckpt: str, partition_by: str | None = None):
    """STR3: exactly-once file sink (per-class folders when ``partition_by``; reading the
    folder unpartitioned is the master)."""
    w = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(partition_by)
    with state_store(df.sparkSession):
        return w.start()


def stream_alerts(stream: DataFrame, levels=DEFAULT_SEVERITIES, col: str = "finding") -> DataFrame:
    """STR4: parse the severity of each new line (CLS4) and keep alert levels (FLT13)."""
    s = stream.withColumn("alert_severity", severity_of(col))
    return s.where(F.col("alert_severity").isin(list(levels)))


def stream_totals(stream: DataFrame, key: str = "vuln_class") -> DataFrame:
    """STR5: running totals per class (stateful aggregate, partial aggregation per batch)."""
    return stream.groupBy(key).agg(F.count("*").alias("findings"))


def start_batches(df: DataFrame, out: str, ckpt: str, mode: str = "update"):
    """Idempotent ``foreachBatch`` sink: each batch writes the folder of its own id, so a replayed
    batch replaces its own rows only and a failure leaves the earlier batches whole."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with state_store(df.sparkSession):
        return (df.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
                .outputMode(mode).trigger(availableNow=True).start())


def read_batches(spark: SparkSession, out: str, schema: StructType | str) -> DataFrame:
    """All rows of a sink of batch folders; none where no batch has written yet."""
    try:
        return spark.read.schema(schema).option("basePath", out).parquet(out)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def latest_rows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The last state of every key that ``start_batches`` wrote in update mode."""
    rows = spark.read.parquet(out)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select(*keys, *[F.col("last")[c].alias(c) for c in values])


def windowed_counts(stream: DataFrame, ts_col: str = "ts", key: str = "event_type",
                    window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """STR7 (extension): event-time tumbling windows with a watermark, which bounds the state;
    rows later than the delay are dropped. Run it in update mode (``start_batches``) to have
    the windows that are still open as well. ``start_windows`` keeps the late rows."""
    s = stream.withColumn("event_ts", event_time(ts_col)).withWatermark("event_ts", delay)
    g = s.groupBy(F.window("event_ts", window).alias("w"), key).agg(F.count("*").alias("events"))
    return g.select(F.unix_seconds(F.col("w.start")).alias("window_start"), key, "events")


COUNTS = "window_start long, {key} string, events long, late boolean, last_micros long"


def start_windows(stream: DataFrame, out: str, ckpt: str, ts_col: str = "ts", key: str = "event_type",
                  window: int = 3600, delay: int = 3600):
    """STR7 with late rows kept: counts by tumbling windows of ``window`` seconds and ``key``, and the
    rows that come too late for their window in a side table, so that windows and late rows
    together are the input. A row is late if its window ended at or before the watermark: the
    latest time of all earlier batches less ``delay`` seconds.

    Each batch writes its own partial counts (``counts``), late rows (``late``) and the latest time so
    far (``progress``) under its id; it reads the one progress row of the batch before. ``windows_of``
    adds the partial counts up. A replayed batch replaces its own folders with the same rows."""
    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts_col}`)")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = read_progress(spark, out, batch_id - 1)
        start = F.floor(micros / F.lit(window * 1_000_000)) * window
        late = F.lit(False) if before is None else (start + window) * 1_000_000 <= before - delay * 1_000_000
        rows = batch.withColumn("_start", start.cast("long")).withColumn("_late", late)
        counts = rows.groupBy(F.col("_start").alias("window_start"), key, F.col("_late").alias("late")).agg(
            F.count("*").alias("events"), F.max(micros).alias("last_micros"))
        counts.select("window_start", key, "events", "late", "last_micros").write.mode("overwrite").parquet(f"{out}/counts/batch={batch_id}")
        written = spark.read.schema(COUNTS.format(key=key)).parquet(f"{out}/counts/batch={batch_id}")
        latest, n_late = written.agg(F.max("last_micros"), F.count_if("late")).first()
        if n_late:
            rows.where("_late").drop("_start", "_late").write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
        latest = max((x for x in (latest, before) if x is not None), default=None)
        spark.createDataFrame([(latest,)], "latest long").coalesce(1).write.mode("overwrite").parquet(f"{out}/progress/batch={batch_id}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True).start())


def read_progress(spark: SparkSession, out: str, batch_id: int) -> int | None:
    """The latest event time, in microseconds, up to a batch; None before the first."""
    if batch_id < 0:
        return None
    return spark.read.schema("latest long").parquet(f"{out}/progress/batch={batch_id}").first()[0]


def windows_of(spark: SparkSession, out: str, key: str = "event_type") -> DataFrame:
    """(window_start, key, events, late_events) of all batches of ``start_windows``."""
    rows = read_batches(spark, f"{out}/counts", COUNTS.format(key=key))
    n = lambda late: F.sum(F.when(F.col("late") == late, F.col("events")).otherwise(0)).alias("late_events" if late else "events")
    return rows.groupBy("window_start", key).agg(n(False), n(True))


def late_rows(spark: SparkSession, out: str, schema: StructType | str) -> DataFrame:
    """The rows that came too late for their windows, as they arrived."""
    return read_batches(spark, f"{out}/late", schema)


def run(query) -> None:
    """Waits until the stream has read all that is there; a failure is raised."""
    query.awaitTermination()
