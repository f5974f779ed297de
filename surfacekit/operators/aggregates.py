"""Aggregations (AGG1-AGG11). All are hash aggregates with map-side partial aggregation,
so a hot key (one tag or class holding a third of the rows) is combined per map task before
the shuffle and sends one row per task, not its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_hosts_per_tag(url_tags: DataFrame, approx: bool = False) -> DataFrame:
    """AGG11: per tag, URL rows and distinct hosts. ``approx`` switches the distinct count
    to HyperLogLog++ (fixed-size state per tag) for very large corpora."""
    hosts = (F.approx_count_distinct("host") if approx else F.countDistinct("host"))
    return url_tags.groupBy("tag").agg(F.count("*").alias("urls"), hosts.alias("hosts"))
