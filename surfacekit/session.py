"""Spark session helpers.

The library never depends on session settings for correctness; these helpers only give
tests and the bench a sensible local session, and give jobs a lineage-cutting folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at cluster scale as much as locally: AQE re-plans joins and
# coalesces / splits shuffle partitions from runtime statistics, and the skew-join rule
# splits hot partitions (one key may hold a third of the rows).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "surfacekit") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("SURFACEKIT_DRIVER_MEM", "16g")))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming state: what the cluster names in
    ``spark.checkpoint.dir``. Unset, it is an error, but for a local session, whose tasks all
    share this machine's folders."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="surfacekit-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path
