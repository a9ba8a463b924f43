"""Queries of joins, aggregates, windows, set operations and quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import text
from terrace.operators import dedup, enrich, nested, quality, quarantine
from terrace.plans.registry import query, table


@query("SELECT l_orderkey, l_linenumber, p_brand, CAST(CAST(l_quantity AS DECIMAL(12,2)) * 100 AS BIGINT) AS quantity_hundredths FROM lineitem JOIN part ON l_partkey = p_partkey")
def fact_inner(spark, d):
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return j.select("l_orderkey", "l_linenumber", "p_brand", (F.col("l_quantity").cast("decimal(12,2)") * 100).cast("bigint").alias("quantity_hundredths"))


_DIM = "SELECT 'nation' AS grain, CAST(n_nationkey AS BIGINT) AS code, 100 + n_nationkey AS zone_id FROM nation UNION ALL SELECT 'region', CAST(r_regionkey AS BIGINT), 500 + r_regionkey FROM region"


@query(f"""WITH dim AS ({_DIM}) SELECT 'customer' AS fact, c_custkey AS k, zone_id FROM customer JOIN dim ON code = c_nationkey AND grain = 'nation'
UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), zone_id FROM nation JOIN dim ON code = n_regionkey AND grain = 'region'""")
def fact_two_grains(spark, d):
    """Surrogate keys of two grains out of one dimension."""
    nations, regions = table(spark, d, "nation"), table(spark, d, "region")
    dim = nations.select(F.lit("nation").alias("grain"), F.col("n_nationkey").cast("bigint").alias("code"), (100 + F.col("n_nationkey")).alias("zone_id")).unionByName(regions.select(F.lit("region").alias("grain"), F.col("r_regionkey").cast("bigint").alias("code"), (500 + F.col("r_regionkey")).alias("zone_id")))
    a = table(spark, d, "customer").join(dim.where("grain = 'nation'"), F.col("c_nationkey") == F.col("code")).select(F.lit("customer").alias("fact"), F.col("c_custkey").alias("k"), "zone_id")
    b = nations.join(dim.where("grain = 'region'"), F.col("n_regionkey") == F.col("code")).select(F.lit("nation").alias("fact"), F.col("n_nationkey").cast("bigint").alias("k"), "zone_id")
    return a.unionByName(b)


@query("""WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders FROM orders GROUP BY 1), b AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1)
SELECT coalesce(a.day, b.day) AS day, n_orders, n_events FROM a FULL JOIN b ON a.day = b.day""")
def series_full_outer(spark, d):
    a = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n_orders"))
    b = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n_events"))
    return enrich.full_series(a, b, "day")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def semi_known(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'")
    return table(spark, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_unknown(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'")
    return table(spark, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders FROM customer")
def exists_marker(spark, d):
    keys = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return enrich.mark_existing(table(spark, d, "customer"), keys, "c_custkey", "has_orders").select("c_custkey", "has_orders")


@query("SELECT g.user_id, n, c_name FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) g LEFT JOIN customer ON c_custkey = g.user_id")
def lookup_after_group(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return enrich.lookup(g, table(spark, d, "customer").withColumnRenamed("c_custkey", "user_id"), "user_id", ["c_name"])


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0) GROUP BY l_orderkey")
def fk_violations(spark, d):
    bad = enrich.violations(table(spark, d, "lineitem"), table(spark, d, "orders").where("o_orderkey % 10 <> 0"), "l_orderkey", "o_orderkey")
    return bad.groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def group_count(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def dup_keys(spark, d):
    return dedup.duplicate_keys(table(spark, d, "documents"), ["text"])


@query("SELECT DISTINCT p_brand, p_type FROM part")
def dim_distinct(spark, d):
    return table(spark, d, "part").select("p_brand", "p_type").distinct()


@query("SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def dedup_latest(spark, d):
    return dedup.dedup_latest(table(spark, d, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "ts")


@query(r"SELECT host, page_id, url FROM (SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, page_id, url, row_number() OVER (PARTITION BY regexp_extract(url, '^[a-z]+://([^/]+)', 1) ORDER BY page_id) AS k FROM pages) WHERE k = 1")
def first_by_url(spark, d):
    p = table(spark, d, "pages").select(F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1).alias("host"), "page_id", "url")
    return dedup.first_by(p, ["host"], ["page_id"])


@query("SELECT r_regionkey, 5 AS n_expected, count(n_nationkey) AS n_found, CASE WHEN count(n_nationkey) = 5 THEN 'OK' ELSE 'DIFFERS' END AS status FROM region LEFT JOIN nation ON n_regionkey = r_regionkey AND n_nationkey <> 7 GROUP BY r_regionkey")
def expected_levels(spark, d):
    expected = table(spark, d, "region").select("r_regionkey", F.lit(5).alias("n_expected"))
    return quality.expected_counts(table(spark, d, "nation").where("n_nationkey <> 7").withColumnRenamed("n_regionkey", "r_regionkey"), "r_regionkey", expected)


@query("""WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS p FROM orders)
SELECT p AS priority, month, count(*) AS n FROM o GROUP BY p, month""")
def rates_unpivot(spark, d):
    """A column a month, turned into rows; absent cells give none."""
    o = table(spark, d, "orders").withColumn("m", F.date_format("o_orderdate", "yyyy-MM-01"))
    months = [r["m"] for r in o.select("m").distinct().orderBy("m").collect()]  # calendar months: a bounded list
    wide = nested.pivot_series(o.withColumnRenamed("o_orderpriority", "priority"), ["priority"], "m", months, F.count(F.lit(1)))
    return nested.unpivot_series(wide, ["priority"], months, "month", "n").select("priority", F.to_date("month").alias("month"), "n")


@query("SELECT user_id, max(CASE WHEN event_type = 'click' THEN event_id END) AS click, max(CASE WHEN event_type = 'view' THEN event_id END) AS view, max(CASE WHEN event_type = 'purchase' THEN event_id END) AS purchase FROM events GROUP BY user_id")
def indicator_pivot(spark, d):
    return nested.pivot_series(table(spark, d, "events"), ["user_id"], "event_type", ["click", "view", "purchase"], F.max("event_id"))


_MONTHS = ", ".join(f"'{m}'" for m in text.MONTHS_FR)


@query(f"""WITH x AS (SELECT CAST(o_orderdate AS DATE) AS day FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem UNION SELECT CAST(ts AS DATE) FROM events)
SELECT day, CAST(year(day) AS INT) AS y, CAST(quarter(day) AS INT) AS q, CAST(month(day) AS INT) AS m, monthname(day) AS month_en, [{_MONTHS}][month(day)] AS month_fr FROM x WHERE day IS NOT NULL""")
def date_dim(spark, d):
    days = [table(spark, d, t).select(F.to_date(c).alias("day")) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))]
    x = reduce(DataFrame.union, days).where("day IS NOT NULL").distinct()
    return x.select("day", F.year("day").alias("y"), F.quarter("day").alias("q"), F.month("day").alias("m"), F.date_format("day", "MMMM").alias("month_en"), text.month_name_fr(F.col("day")).alias("month_fr"))


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES))
def row_counts(spark, d):
    return quality.row_counts({t: table(spark, d, t) for t in _TABLES})


@query("SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS k FROM events WHERE event_type = 'view') WHERE k = 1 ORDER BY ts DESC, event_id LIMIT 1")
def top_latest_log(spark, d):
    e = table(spark, d, "events").where("event_type = 'view'")
    return enrich.latest(e, ["user_id"], [F.desc("ts"), F.col("event_id")]).orderBy(F.desc("ts"), "event_id").limit(1).select("user_id", "event_type", "event_id", "ts")


@query("SELECT event_type, count(*) AS n, count(*) FILTER (user_id % 2 = 0) AS n_even, count(*) FILTER (value IS NULL) AS n_null FROM events GROUP BY event_type")
def conditional_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("user_id") % 2 == 0).alias("n_even"), F.count_if(F.col("value").isNull()).alias("n_null"))


@query("SELECT CAST((SELECT count(*) FROM orders) + (SELECT count(*) FROM events) + (SELECT count(*) FROM lineitem) AS BIGINT) AS n_rows")
def counts_summed(spark, d):
    return quality.row_counts({t: table(spark, d, t) for t in ("orders", "events", "lineitem")}).agg(F.sum("n_rows").alias("n_rows"))


@query("SELECT l_orderkey, l_partkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INT) AS row_no FROM lineitem")
def table_row_numbers(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.row_number().over(w).alias("row_no"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def sample_first_n(spark, d):
    """A trial run's first units: the limit is the feature."""
    return table(spark, d, "customer").orderBy("c_custkey").limit(10).select("c_custkey", "c_name")


@query("SELECT n_regionkey, list_sort(list(DISTINCT n_name)) AS names FROM nation GROUP BY n_regionkey")
def sorted_keys(spark, d):
    return table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_set("n_name")).alias("names"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')")
def union_parts(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return reduce(DataFrame.unionByName, (o.where(F.col("o_orderpriority") == p) for p in ("1-URGENT", "2-HIGH", "5-LOW")))


_CHECK = "SELECT '{0}' AS table_name, '{1}' AS check_name, CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END AS status, m AS n_failing, n AS n_total FROM (SELECT count(*) AS n, count(*) FILTER ({2}) AS m FROM {0})"


@query(_CHECK.format("labels", "doc_id not null", "doc_id IS NULL") + " UNION ALL " + _CHECK.format("labels", "toxic not null", "toxic IS NULL"))
def completeness(spark, d):
    return quality.completeness(table(spark, d, "labels"), "labels", ["doc_id", "toxic"])


@query("SELECT 'documents' AS table_name, 'quality coverage' AS check_name, CASE WHEN m = 0 THEN 'PASS' WHEN m < n * 0.25 THEN 'WARN' ELSE 'FAIL' END AS status, m AS n_failing, n AS n_total FROM (SELECT count(*) AS n, count(*) FILTER (quality IS NULL) AS m FROM documents LEFT JOIN labels USING (doc_id))")
def coverage_tristate(spark, d):
    return quality.coverage(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left"), "documents", "quality")


@query("SELECT 'lineitem' AS table_name, 'l_orderkey+l_linenumber unique' AS check_name, CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END AS status, m AS n_failing, n AS n_total FROM (SELECT count(*) AS n, count(*) FILTER (c > 1) AS m FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber))")
def uniqueness(spark, d):
    return quality.uniqueness(table(spark, d, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


@query("SELECT 'customer' AS table_name, 'c_custkey has children' AS check_name, CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END AS status, m AS n_failing, n AS n_total FROM (SELECT count(*) AS n, count(*) FILTER (c_custkey NOT IN (SELECT o_custkey FROM orders)) AS m FROM customer)")
def referential(spark, d):
    return quality.referential(table(spark, d, "customer"), table(spark, d, "orders"), "customer", "c_custkey", "o_custkey")


@query("""SELECT 'l_discount out of range' AS constraint_name, count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.05) AS violations FROM lineitem
UNION ALL SELECT 'l_returnflag not allowed', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem UNION ALL SELECT 'l_tax missing', count(*) FILTER (l_tax IS NULL) FROM lineitem""")
def constraint_report(spark, d):
    return quarantine.constraint_report(table(spark, d, "lineitem"), [quarantine.in_range("l_discount", 0, 0.05), quarantine.one_of("l_returnflag", ["A", "N"]), quarantine.not_null("l_tax")])


@query("SELECT event_type, count(*) AS n_rows, CASE WHEN count(*) >= 2000 THEN 'CAPPED' ELSE 'OK' END AS status FROM events GROUP BY event_type")
def cap_guard(spark, d):
    return quality.cap_guard(table(spark, d, "events"), "event_type", 2000)


@query("""WITH s AS (SELECT user_id, max(ts) AS started_at FROM events WHERE event_type = 'view' GROUP BY user_id),
e AS (SELECT s.user_id, s.started_at, p.ts AS ended_at, p.event_id, row_number() OVER (PARTITION BY s.user_id ORDER BY p.ts, p.event_id) AS k FROM s JOIN events p ON p.user_id = s.user_id AND p.event_type = 'purchase' AND p.ts >= s.started_at)
SELECT s.user_id AS load_key, s.started_at, e.ended_at, CASE WHEN e.user_id IS NULL THEN 'RUNNING' ELSE 'SUCCESS' END AS status, CAST((epoch_us(e.ended_at) - epoch_us(s.started_at)) // 1000 AS BIGINT) AS duration_ms
FROM s LEFT JOIN e ON s.user_id = e.user_id AND k = 1""")
def load_log_rows(spark, d):
    """Views start a load, purchases end it."""
    e = table(spark, d, "events")
    start, end = F.col("event_type") == "view", F.col("event_type") == "purchase"
    log = e.where(start | end).select(F.col("user_id").alias("load_key"), F.when(start, F.col("ts")).alias("started_at"), F.when(end, F.col("ts")).alias("ended_at"), F.lit("SUCCESS").alias("status"), F.col("event_id").alias("n_rows"), F.lit(None).cast("string").alias("message"))
    return quality.load_log(log).select("load_key", "started_at", "ended_at", "status", "duration_ms")
