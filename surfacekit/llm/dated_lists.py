"""Captures and dated list entries that Spark derives from ``pages`` (which has neither fetch
times nor lists): fetch dates and list events follow from md5 digits of the url and of the
pattern, so they grow with the table and are the same in Spark and in the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surfacekit.llm.url_lists import host_of

LISTS = ("adult", "phishing", "spam")  # fixed values
START = "2024-01-01"


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int")


def captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.date_add(F.lit(START).cast("date"), _number(F.col("url")) % 365).alias("fetched_on"))


def entries(pages: DataFrame) -> DataFrame:
    """Hosts and their last two labels are added to lists, some removed again, some added back."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    domain = F.substring_index("host", ".", -2)
    patterns = hosts.select(F.explode(F.array("host", domain)).alias("pattern")).distinct()
    rows = patterns.select("pattern", F.explode(F.array(*map(F.lit, LISTS))).alias("list")).withColumn(
        "h", _number(F.concat_ws(":", "pattern", "list"))).where("h % 4 = 0")
    day = lambda c: F.date_add(F.lit(START).cast("date"), c.cast("int"))
    added = F.col("h") % 300
    removed = added + 1 + F.floor(F.col("h") / 11) % 60
    return (rows.select("list", "pattern", F.lit("add").alias("action"), day(added).alias("on_date"))
            .unionByName(rows.where("floor(h / 7) % 3 = 0").select("list", "pattern", F.lit("remove").alias("action"), day(removed).alias("on_date")))
            .unionByName(rows.where("floor(h / 13) % 4 = 0").select("list", "pattern", F.lit("add").alias("action"), day(removed + 70).alias("on_date"))))


ORACLE = r"""
WITH cap AS (
  SELECT page_id, url, DATE '2024-01-01' + (('0x' || substr(md5(url), 1, 6))::BIGINT % 365)::INTEGER AS fetched_on,
         nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '.'), '') AS host
  FROM pages),
pats AS (
  SELECT DISTINCT unnest([host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.')]) AS pattern
  FROM cap WHERE host IS NOT NULL),
listed AS (
  SELECT pattern, list, ('0x' || substr(md5(pattern || ':' || list), 1, 6))::BIGINT AS h
  FROM pats, (SELECT unnest(['adult', 'phishing', 'spam']) AS list)),
ev AS (
  SELECT pattern, list, 1 AS act, DATE '2024-01-01' + (h % 300)::INTEGER AS d FROM listed WHERE h % 4 = 0
  UNION ALL
  SELECT pattern, list, 0, DATE '2024-01-01' + (h % 300 + 1 + (h // 11) % 60)::INTEGER FROM listed WHERE h % 4 = 0 AND (h // 7) % 3 = 0
  UNION ALL
  SELECT pattern, list, 1, DATE '2024-01-01' + (h % 300 + 1 + (h // 11) % 60 + 70)::INTEGER FROM listed WHERE h % 4 = 0 AND (h // 13) % 4 = 0),
daily AS (SELECT pattern, list, d, min(act) AS act FROM ev GROUP BY ALL),
asked AS (
  SELECT DISTINCT c.host, c.fetched_on, d.list, d.pattern FROM cap c JOIN (SELECT DISTINCT list, pattern FROM daily) d
  ON c.host = d.pattern OR ends_with(c.host, '.' || d.pattern)),
state AS (
  SELECT a.host, a.fetched_on, a.list, max(e.act) AS act
  FROM asked a ASOF JOIN daily e ON a.pattern = e.pattern AND a.list = e.list AND a.fetched_on >= e.d GROUP BY ALL),
found AS (SELECT host, fetched_on, count(*) AS n, string_agg(list, ',' ORDER BY list) AS lists FROM state WHERE act = 1 GROUP BY ALL)
SELECT c.page_id, c.url, c.fetched_on, c.host, coalesce(f.n, 0)::INTEGER AS n_lists, coalesce(f.lists, '') AS lists,
       f.n IS NOT NULL AS blocked
FROM cap c LEFT JOIN found f ON c.host = f.host AND c.fetched_on = f.fetched_on
"""
