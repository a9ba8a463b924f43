"""Queries of sources, sinks, upserts, change detection and the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators import enrich, incremental
from terrace.plans.registry import query, table
from terrace.sources import readers, sinks
from terrace.sources.merged import MergedTable
from terrace.sources.storage import shared_path
from terrace.streaming.upsert import stream_upsert


def _as_text(df, path):
    """A table as a CSV export."""
    df.select(*(F.col(c).cast("string").alias(c) for c in df.columns)).write.option("header", True).option("escape", '"').csv(path)
    return path


@query("SELECT CAST(p_partkey AS VARCHAR) AS k, p_name AS name, p_brand AS brand, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS kind, 'batch-1' AS _bronze_batch_id FROM part")
def text_ingest(spark, d):
    """CSV by position into all-text columns, audit columns, full load, batch id carried on."""
    part = table(spark, d, "part").withColumn("p_type", F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")))
    path = _as_text(part.select("p_partkey", "p_name", "p_brand", "p_type"), shared_path(spark, "csv"))
    bronze = readers.with_audit(readers.read_text_csv(spark, path, ["k", "name", "brand", "kind"]), "batch-1", "part.csv")
    return readers.carry_batch(sinks.full_load(bronze, shared_path(spark, "bronze")))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name AS name, 'nation' AS kind FROM nation UNION ALL SELECT CAST(r_regionkey AS VARCHAR), r_name, 'region' FROM region UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, 'supplier' FROM supplier")
def multi_file_ingest(spark, d):
    base = shared_path(spark, "many")
    parts = (("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name"), ("supplier", "s_suppkey", "s_name"))
    paths = [_as_text(table(spark, d, t).select(k, n), f"{base}/{t}") for t, k, n in parts]
    rows = readers.read_many_text_csv(spark, paths, ["k", "name"]).withColumn("kind", F.element_at(F.split("_source_file", "/"), -2))
    return rows.select("k", "name", "kind")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, NULL::VARCHAR AS balance FROM nation UNION ALL SELECT CAST(s_suppkey AS VARCHAR), NULL, CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS VARCHAR) FROM supplier")
def theme_directory(spark, d):
    base = shared_path(spark, "themes")
    a = _as_text(table(spark, d, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")), f"{base}/a")
    b = _as_text(table(spark, d, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_acctbal").cast("decimal(14,2)").alias("balance")), f"{base}/b")
    return readers.read_theme_directory(spark, [b, a]).select("code", "name", "balance")


@query("SELECT CAST(c_custkey AS VARCHAR) AS osm_id, c_name AS name, 8 AS admin_level, 'commune' AS level_label, CAST(c_nationkey AS VARCHAR) AS first_lon FROM customer")
def geojson_rows(spark, d):
    """Feature collections, one for each nation, built from the customers and exploded again."""
    feature = F.struct(F.lit("Feature").alias("type"), F.create_map(F.lit("GID_1"), F.col("c_custkey").cast("string"), F.lit("NAME_1"), F.col("c_name")).alias("properties"), F.struct(F.lit("Point").alias("type"), F.array(F.col("c_nationkey"), F.lit(0)).alias("coordinates")).alias("geometry"))
    # salted, so that no collection grows with a hot nation
    groups = table(spark, d, "customer").groupBy("c_nationkey", (F.col("c_custkey") / 64).cast("bigint")).agg(F.collect_list(feature).alias("features"))
    docs = groups.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("j"))
    rows = readers.geojson_rows(docs, "j", "NAME_1", "GID_1", 8, "commune")
    return rows.withColumn("first_lon", F.get_json_object("geojson_geom", "$.coordinates[0]")).drop("geojson_geom")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS osm_id, s_name AS name, 4 AS admin_level, 'region' AS level_label, CAST(s_nationkey AS VARCHAR) AS first_lon FROM supplier")
def geojson_files(spark, d):
    """Collections of at most 256 suppliers, a file each, read as files."""
    path = shared_path(spark, "geojson")
    feature = F.struct(F.lit("Feature").alias("type"), F.create_map(F.lit("ID"), F.col("s_suppkey").cast("string"), F.lit("NAME"), F.col("s_name")).alias("properties"), F.struct(F.lit("Point").alias("type"), F.array(F.col("s_nationkey"), F.lit(0)).alias("coordinates")).alias("geometry"))
    groups = table(spark, d, "supplier").groupBy((F.col("s_suppkey") / 256).cast("bigint").alias("part")).agg(F.collect_list(feature).alias("features"))
    groups.select("part", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.partitionBy("part").text(path)
    rows = readers.read_geojson(spark, path, "NAME", "ID", 4, "region")
    return rows.withColumn("first_lon", F.get_json_object("geojson_geom", "$.coordinates[0]")).drop("geojson_geom")


@query("SELECT 1 AS n_batches, count(*) AS n_rows, 36 AS id_length FROM supplier")
def batch_lineage(spark, d):
    """One new batch id for all rows of a run, carried from bronze to silver."""
    bronze = readers.with_audit(table(spark, d, "supplier").select("s_suppkey"), readers.new_batch_id(), "supplier.csv")
    silver = readers.carry_batch(sinks.full_load(bronze, shared_path(spark, "batches")))
    return silver.agg(F.count_distinct("_bronze_batch_id").cast("int").alias("n_batches"), F.count("*").alias("n_rows"), F.max(F.length("_bronze_batch_id")).alias("id_length"))


@query("SELECT event_id, event_type, user_id FROM events")
def log_read(spark, d):
    path = shared_path(spark, "log")
    sinks.write_json(table(spark, d, "events").select("event_id", "event_type", "user_id"), path)
    return readers.read_run_log(spark, path, "event_id bigint, event_type string, user_id bigint")


@query("SELECT event_id, user_id, event_type, CAST(event_id % 2 AS INT) AS half FROM events")
def long_fact_write(spark, d):
    """Two appends to a table partitioned by type, read back."""
    path = shared_path(spark, "facts")
    e = table(spark, d, "events").select("event_id", "user_id", "event_type")
    for half in (0, 1):
        sinks.append(e.where(F.col("event_id") % 2 == half).withColumn("half", F.lit(half)), path, ["event_type"])
    return spark.read.schema("event_id bigint, user_id bigint, half int, event_type string").parquet(path).select("event_id", "user_id", "event_type", "half")


@query("SELECT page_id, url, sha256(html) AS content_sha256, CAST(strlen(html) AS INT) AS size_bytes, '2026-01-01T00-00' AS snapshot_ts FROM pages")
def page_source(spark, d):
    path = shared_path(spark, "pages")
    sinks.write_snapshot(readers.list_raw_pages(table(spark, d, "pages")).drop("html"), path, "2026-01-01T00-00")
    return spark.read.parquet(path).withColumn("snapshot_ts", F.col("snapshot_ts").cast("string"))


_BATCH = "SELECT o_orderkey, o_orderstatus, CAST(o_totalprice * 2 AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT -o_orderkey, 'N', o_totalprice FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey > 0"


def _batches(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = o.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    new = o.where("o_orderkey % 7 = 0 AND o_orderkey > 0").select((-F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice")
    return o, changed.unionByName(new)


@query(f"WITH i AS ({_BATCH}) SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM i) UNION ALL SELECT * FROM i")
def upsert_update(spark, d):
    old, new = _batches(spark, d)
    twice = new.unionByName(new.withColumn("o_totalprice", F.col("o_totalprice") - 1))  # a repeated key: the greater price counts
    return sinks.upsert_update(old, twice, ["o_orderkey"], [F.desc("o_totalprice")])


@query(f"WITH i AS ({_BATCH}) SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders UNION ALL SELECT * FROM i WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def upsert_ignore(spark, d):
    old, new = _batches(spark, d)
    return sinks.upsert_ignore(old, new, ["o_orderkey"], [F.desc("o_totalprice")])


def _merged(spark, d, mode, low=None, high=None):
    """The orders as one run and the incoming rows as three more, one of which comes twice, merged on read."""
    old, new = _batches(spark, d)
    merged = MergedTable(spark, shared_path(spark, "merged"), old.schema, ["o_orderkey"], mode=mode)
    earlier = new.withColumn("o_totalprice", F.col("o_totalprice") - 1)
    for number, batch in enumerate((old, earlier.where("o_orderkey % 2 = 0") if mode == "update" else new.where("o_orderkey % 2 = 0"), new, new)):
        merged.merge(batch, min(number, 2))
    return merged.read(low, high)


@query(f"WITH i AS ({_BATCH}) SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM i) UNION ALL SELECT * FROM i")
def upsert_merged(spark, d):
    return _merged(spark, d, "update")


@query(f"WITH i AS ({_BATCH}) SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders UNION ALL SELECT * FROM i WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def upsert_merged_ignore(spark, d):
    return _merged(spark, d, "ignore")


@query(f"WITH i AS ({_BATCH}) SELECT * FROM (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM i) UNION ALL SELECT * FROM i) WHERE o_orderkey BETWEEN -500 AND 900")
def upsert_merged_range(spark, d):
    """A range of keys: runs beside it aren't opened, and the filter reaches the files of the others."""
    return _merged(spark, d, "update", -500, 900)


@query("SELECT p_partkey, p_brand, CAST(row_number() OVER (ORDER BY p_brand, p_partkey) AS BIGINT) AS id FROM part")
def surrogate_keys(spark, d):
    return sinks.surrogate_key(table(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand", "p_partkey"])


@query("SELECT url, sha256(html) AS content_sha256, CASE WHEN page_id % 4 = 0 THEN 'NEW' WHEN page_id % 9 = 0 THEN 'NEW' ELSE 'UNCHANGED' END AS status FROM pages")
def hash_change(spark, d):
    """Against a state in which each ninth page has other content and each fourth is missing; an address may have several pages."""
    pages = table(spark, d, "pages")
    state = pages.where("page_id % 4 <> 0").select("page_id", "url", F.sha2(F.when(F.col("page_id") % 9 == 0, F.concat(F.coalesce("html", F.lit("")), F.lit(" "))).otherwise(F.col("html")), 256).alias("content_sha256"))
    return incremental.detect_changes(pages, state, ["page_id", "url"]).drop("page_id")


@query("SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def run_log_state(spark, d):
    return incremental.last_state(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts")


@query("SELECT url, CASE WHEN page_id % 11 = 0 THEN 'ERROR' ELSE 'NEW' END AS status, CASE WHEN page_id % 11 = 0 THEN 'timeout' END AS error_message, '2026-01-01' AS scraped_at FROM pages")
def run_log_rows(spark, d):
    pages = table(spark, d, "pages")
    empty = spark.createDataFrame([], "url string, content_sha256 string")
    changes = incremental.detect_changes(pages.where("page_id % 11 <> 0"), empty)
    return incremental.run_log(changes, pages.where("page_id % 11 = 0").select("url", F.lit("timeout").alias("error_message")), "url", "2026-01-01")


@query("SELECT n_name, b.p_brand, n_name || '|' || b.p_brand AS work_key FROM nation, (SELECT DISTINCT p_brand FROM part) b")
def work_grid(spark, d):
    return enrich.work_grid(table(spark, d, "nation").select("n_name"), table(spark, d, "part").select("p_brand").distinct())


@query("SELECT c_custkey AS user_id, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def resume_anti(spark, d):
    work = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return incremental.pending(work, table(spark, d, "events").where("event_type = 'purchase'"), "user_id")


@query("""SELECT 'k' AS column_name, 'INTEGER' AS sql_type, (SELECT count(*) FROM events) AS n UNION ALL SELECT 'type', 'TEXT', (SELECT count(*) FROM events) UNION ALL SELECT 'v', 'REAL', (SELECT count(*) FROM events WHERE event_id % 2 = 0)""")
def ragged_types(spark, d):
    """Records of differing keys, spread into columns whose types are then inferred."""
    e = table(spark, d, "events")
    data = F.map_concat(F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("type"), F.col("event_type")), F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("v"), F.concat(F.col("event_id").cast("string"), F.lit(".5")))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
    wide = sinks.spread_ragged(e.select("event_id", data.alias("data")), ["event_id"])
    columns = [c for c in wide.columns if c != "event_id"]
    filled = wide.agg(*(F.count(c).alias(c) for c in columns)).unpivot([], columns, "column_name", "n")
    return sinks.ragged_types(wide, columns).join(filled, "column_name").select("column_name", "sql_type", "n")


@query("SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events WHERE event_type <> 'error') WHERE k = 1")
def stream_upsert_files(spark, d):
    """The events land in three files; the newest row of each key stays."""
    landing, out = shared_path(spark, "landing"), shared_path(spark, "stream")
    e = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    result = None
    for k in (2, 0, 1):
        e.where(F.col("event_id") % 3 == k).write.mode("append").parquet(landing)
        result = stream_upsert(spark, landing, e.schema, f"{out}/table", f"{out}/state", ["user_id", "event_type"], "event_id", [("error event", F.col("event_type") != "error")])
    return result
