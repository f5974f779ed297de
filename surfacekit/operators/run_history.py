"""SET4: the history of assets over many runs, as validity intervals.

history(asset, since, until): the asset was in every run from ``since`` to before ``until``; an open
interval has no ``until``. Runs are numbered in their order. One row for each stretch of presence,
however many runs it spans, so any two runs are compared from the intervals alone, and a new run
touches only what it opens or closes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HISTORY = ("asset", "since", "until")


def present(run: int) -> Column:
    """Whether an interval covers a run."""
    return (F.col("since") <= run) & (F.col("until").isNull() | (F.col("until") > run))


def history_of(sightings: DataFrame, last_run: int, asset: str = "asset", run: str = "run") -> DataFrame:
    """sightings(asset, run): the intervals of all runs up to ``last_run`` in one pass. Distinct
    sightings are partially aggregated before the shuffle; each asset's runs are then numbered,
    and runs in a row keep their distance to that number. Null assets or runs are left out."""
    seen = sightings.select(F.col(asset).alias("asset"), F.col(run).cast("long").alias("run")).where("asset is not null and run is not null").distinct()
    island = F.col("run") - F.row_number().over(Window.partitionBy("asset").orderBy("run"))
    stretches = seen.withColumn("island", island).groupBy("asset", "island").agg(F.min("run").alias("since"), (F.max("run") + 1).alias("until"))
    return stretches.select("asset", "since", F.when(F.col("until") <= last_run, F.col("until")).alias("until"))


def merge_run(history: DataFrame, assets: DataFrame, run: int, asset: str = "asset") -> DataFrame:
    """The history after one more run: open intervals of assets that it lacks end before it, assets
    that had none open begin with it. Closed intervals pass unread by the join."""
    now = assets.select(F.col(asset).alias("asset")).where("asset is not null").distinct()
    closed = history.where("until is not null").select(*HISTORY)
    both = history.where("until is null").select("asset", "since").join(now.withColumn("now", F.lit(True)), "asset", "full_outer")
    moved = both.select("asset", F.coalesce("since", F.lit(run).cast("long")).alias("since"),
                        F.when(F.col("now").isNull(), F.lit(run).cast("long")).alias("until"))
    return closed.unionByName(moved)


def diff_runs(history: DataFrame, before: int, after: int) -> DataFrame:
    """(asset, status): added, removed or kept between two runs, from the intervals only. An asset
    that was away in between counts as kept."""
    states = history.where(present(before) | present(after)).groupBy("asset").agg(
        F.bool_or(present(before)).alias("was"), F.bool_or(present(after)).alias("is"))
    status = F.when(~F.col("was"), "added").when(~F.col("is"), "removed").otherwise("kept")
    return states.select("asset", status.alias("status"))


def churn(history: DataFrame) -> DataFrame:
    """(run, opened, closed): how many assets came and went with each run."""
    moves = history.select(F.explode(F.array(F.struct(F.col("since").alias("run"), F.lit(1).alias("opened")),
                                             F.struct(F.col("until").alias("run"), F.lit(0).alias("opened")))).alias("m")).select("m.*").where("run is not null")
    return moves.groupBy("run").agg(F.sum("opened").cast("long").alias("opened"), F.sum(1 - F.col("opened")).cast("long").alias("closed"))
