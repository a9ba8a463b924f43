"""Operator 5: URL filters as a temporal list join, in DataFrame functions alone.

A dated list says on which day a key was put on it or taken off. Each entry holds from its day until
the next entry of its key, which makes validity intervals. A capture has the keys under which a list
may know it: its host, each domain above it, and its host with the first part of its path. The
as-of join brings each capture together with the entries of its keys that are active on the day it was
fetched, and the most specific of them decides. Lists have few entries a key, so a host with very
many captures multiplies nothing, and its rows may be split over tasks.

Defined results: a capture without URL, host or day, or that no active entry knows, has the decision
"none"; of several entries of one key and day, the one that takes it off the list counts; entries
without key or day are ignored; repeated captures give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user and port; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def capture_keys(url: Column) -> Column:
    """Array of (specificity, key): domains by their number of labels, the host above them, then host and path."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda k: F.struct(k.alias("rank"), F.concat(F.lit("domain:"), F.array_join(F.slice(labels, n - k + 1, k), ".")).alias("key")))
    path = F.regexp_extract(url, r"^[^:]+://[^/?#]+(/[^/?#]+)", 1)
    exact = F.array(F.struct(F.lit(1000).alias("rank"), F.concat(F.lit("host:"), host).alias("key")), F.struct(F.lit(2000).alias("rank"), F.concat(F.lit("path:"), host, path).alias("key")))
    return F.concat(F.filter(domains, lambda d: d["rank"] <= n), F.filter(exact, lambda d: (d["rank"] < 2000) | (path != "")))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, label, valid_from, valid_to) from dated entries (key, label, action: add or remove, day); valid_to is exclusive."""
    day = Window.partitionBy("key").orderBy("day")
    dated = entries.where(F.col("key").isNotNull() & F.col("day").isNotNull())
    # one entry a key and day: a removal counts before additions, then the least label
    single = dated.groupBy("key", "day").agg(F.min(F.struct((F.col("action") != "remove").alias("adds"), F.col("label").alias("label"))).alias("_e"))
    spans = single.select("key", "_e.adds", "_e.label", F.col("day").alias("valid_from"), F.lead("day").over(day).alias("valid_to"))
    return spans.where("adds").drop("adds")


def apply_lists(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """capture_id, url, day, decision, key, valid_from, valid_to of every capture (capture_id, url, day)."""
    valid = intervals(entries).withColumnRenamed("key", "_key")
    # a row number from its partition and place, the same again if a task is repeated
    numbered = captures.select("capture_id", "url", "day", F.monotonically_increasing_id().alias("_row"))
    keyed = numbered.select("capture_id", "url", "day", "_row", F.explode_outer(capture_keys(F.col("url"))).alias("_k")).select("capture_id", "url", "day", "_row", F.col("_k.rank").alias("_rank"), F.col("_k.key").alias("_of"))
    active = (F.col("_of") == F.col("_key")) & (F.col("day") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to")))
    joined = keyed.join(valid, active, "left")
    hit = F.struct("_rank", "_key", "label", "valid_from", "valid_to")
    best = joined.groupBy("_row", "capture_id", "url", "day").agg(F.max(F.when(F.col("_key").isNotNull(), hit)).alias("_m"))
    return best.select("capture_id", "url", "day", F.coalesce("_m.label", F.lit("none")).alias("decision"), F.col("_m._key").alias("key"), F.col("_m.valid_from").alias("valid_from"), F.col("_m.valid_to").alias("valid_to"))


def _digit(key: Column, at: int) -> Column:
    """A number below 65,536 from a key, as both engines can compute it."""
    return F.conv(F.substring(F.md5(key.cast("binary")), at, 4), 16, 10).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures, with a fetch day from their id: the tables hold no fetch times."""
    return pages.select(F.col("page_id").cast("long").alias("capture_id"), F.col("url").cast("string").alias("url"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id").cast("long") * 37, F.lit(366)).cast("int")).alias("day"))


def lists_of(pages: DataFrame) -> DataFrame:
    """Dated entries for the hosts, domains and first path parts of the pages: the tables hold no lists.

    Keys, days and labels follow from digests of the keys: a third of the keys are listed, taken
    off again after some weeks, and half of these listed once more.
    """
    keys = pages.select(F.explode(capture_keys(F.col("url").cast("string"))).alias("_k")).select("_k.key").distinct()
    start = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(_digit(F.col("key"), 1), F.lit(200)))
    stay = 20 + F.pmod(_digit(F.col("key"), 5), F.lit(100))
    label = F.when(F.pmod(_digit(F.col("key"), 9), F.lit(4)) == 0, "allow").otherwise("block")
    listed = keys.where(F.pmod(_digit(F.col("key"), 13), F.lit(3)) == 0).withColumns({"_start": start, "_stay": stay, "label": label})
    again = F.pmod(_digit(F.col("key"), 17), F.lit(2)) == 0
    moments = F.array(F.struct(F.lit("add").alias("action"), F.col("_start").alias("day")), F.struct(F.lit("remove").alias("action"), F.date_add("_start", F.col("_stay")).alias("day")), F.struct(F.lit("add").alias("action"), F.when(again, F.date_add("_start", F.col("_stay") + 30)).alias("day")))
    return listed.select("key", "label", F.explode(moments).alias("_m")).select("key", "label", "_m.action", "_m.day")


def filter_pages(pages: DataFrame) -> DataFrame:
    found = apply_lists(captures_of(pages), lists_of(pages))
    return found.withColumnRenamed("capture_id", "page_id")


FILTER_SQL = r"""
WITH captures AS (
  SELECT page_id, url, CAST(DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INT) AS DATE) AS day,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') AS host,
    regexp_extract(url, '^[^:]+://[^/?#]+(/[^/?#]+)', 1) AS path,
    row_number() OVER () AS rn
  FROM pages),
parts AS (SELECT *, string_split(host, '.') AS labels FROM captures),
keyed AS (
  SELECT rn, day, k AS rank, 'domain:' || array_to_string(labels[len(labels) - k + 1:], '.') AS key
  FROM parts, unnest(range(2, len(labels) + 1)) AS r(k) WHERE host IS NOT NULL
  UNION ALL SELECT rn, day, 1000, 'host:' || host FROM parts WHERE host IS NOT NULL
  UNION ALL SELECT rn, day, 2000, 'path:' || host || path FROM parts WHERE host IS NOT NULL AND path <> ''),
hashed AS (
  SELECT key, CAST('0x' || md5(key)[1:4] AS INT) AS a, CAST('0x' || md5(key)[5:8] AS INT) AS b, CAST('0x' || md5(key)[9:12] AS INT) AS c,
    CAST('0x' || md5(key)[13:16] AS INT) AS d, CAST('0x' || md5(key)[17:20] AS INT) AS e
  FROM (SELECT DISTINCT key FROM keyed)),
listed AS (
  SELECT key, CASE WHEN c % 4 = 0 THEN 'allow' ELSE 'block' END AS label, CAST(DATE '2024-01-01' + a % 200 AS DATE) AS first_day, 20 + b % 100 AS stay, e % 2 = 0 AS again
  FROM hashed WHERE d % 3 = 0),
valid AS (
  SELECT key, label, first_day AS valid_from, CAST(first_day + CAST(stay AS INT) AS DATE) AS valid_to FROM listed
  UNION ALL SELECT key, label, CAST(first_day + CAST(stay + 30 AS INT) AS DATE), CAST(NULL AS DATE) FROM listed WHERE again),
hits AS (
  SELECT k.rn, v.*, row_number() OVER (PARTITION BY k.rn ORDER BY k.rank DESC) AS place
  FROM keyed k JOIN valid v ON k.key = v.key AND k.day >= v.valid_from AND (v.valid_to IS NULL OR k.day < v.valid_to))
SELECT c.page_id, c.url, c.day, coalesce(h.label, 'none') AS decision, h.key, h.valid_from, h.valid_to
FROM captures c LEFT JOIN (SELECT * FROM hits WHERE place = 1) h ON c.rn = h.rn
"""
