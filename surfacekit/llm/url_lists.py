"""URL filters: dated list entries against captures, as of the time of each fetch.

An entry says that a pattern (a host or domain, which covers its subdomains) was added to or
removed from a list on a date. Entries become disjoint validity intervals, and a capture is
matched to the intervals that hold its fetch date. Patterns are equi-joined with the label
suffixes of the hosts; each host and date is judged once, however many captures it has, so a
host with a third of all captures costs no more than its number of days.

A null url, or one without a host, is on no list. A null date, pattern, list or action makes an
entry void; a null fetch date is on no list. Of an addition and a removal on one date the
removal counts; repeated entries and captures change nothing. An entry holds from its date on,
a removal ends it on its date. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """The lower-cased host without user, port and trailing dot; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to): disjoint half-open intervals; valid_to is null while
    the entry holds. There is one state a date first, so a pattern has a row a date at most."""
    daily = (entries.where("list is not null and pattern is not null and on_date is not null and action in ('add', 'remove')")
             .groupBy("list", F.lower("pattern").alias("pattern"), "on_date").agg(F.min((F.col("action") == "add").cast("int")).alias("on")))
    w = Window.partitionBy("list", "pattern").orderBy("on_date")
    turns = daily.withColumn("was", F.coalesce(F.lag("on").over(w), F.lit(0))).where("on != was")
    spans = turns.withColumn("valid_to", F.lead("on_date").over(w)).where("on = 1")
    return spans.select("list", "pattern", F.col("on_date").alias("valid_from"), "valid_to")


def listed(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, fetched_on, host, n_lists, lists (sorted, joined by commas) and blocked for
    every capture."""
    pages = captures.select("page_id", "url", "fetched_on", host_of(F.col("url")).alias("host"))
    visits = pages.where("host is not null and fetched_on is not null").select("host", "fetched_on").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    keys = visits.select("host", "fetched_on", F.explode(suffixes).alias("pattern"))
    active = (keys.join(validity_intervals(entries), "pattern")
              .where("valid_from <= fetched_on and (valid_to is null or fetched_on < valid_to)"))
    found = active.groupBy("host", "fetched_on").agg(F.array_sort(F.collect_set("list")).alias("found"))
    n = F.coalesce(F.size("found"), F.lit(0))
    return pages.join(found, ["host", "fetched_on"], "left").select(
        "page_id", "url", "fetched_on", "host", F.when(F.col("found").isNull(), 0).otherwise(n).alias("n_lists"),
        F.coalesce(F.array_join("found", ","), F.lit("")).alias("lists"), F.col("found").isNotNull().alias("blocked"))
