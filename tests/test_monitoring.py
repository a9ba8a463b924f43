"""Kept logs, counters that come with the write, malformed input, reloads, circles on the sphere, names of any script."""

import math
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from terrace.jobs import census
from terrace.operators import enrich, monitoring, quality, spatial
from terrace.sources import readers, sinks


class Jobs:
    """Jobs that Spark ran inside the block, by a group of their own."""

    def __init__(self, spark, name):
        self.context, self.name = spark.sparkContext, name

    def __enter__(self):
        self.context.setJobGroup(self.name, self.name)
        return self

    def __exit__(self, *_):
        self.count = len(self.context.statusTracker().getJobIdsForGroup(self.name))
        self.context.setLocalProperty("spark.jobGroup.id", None)


def test_split_and_counters_are_one_job(spark, tmp_path):
    df = spark.range(1000).withColumn("v", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")))
    rules = [("missing", F.col("v").isNotNull()), ("large", F.col("v") < 900)]
    with Jobs(spark, "split") as jobs:
        valid, rejects, told = monitoring.write_split(df, rules, f"{tmp_path}/split")
    assert jobs.count == 1 and told == {"": 810, "missing": 100, "large": 90}
    assert valid.columns == ["id", "v"] and valid.count() == 810
    assert {r["reject_reason"]: r["count"] for r in rejects.groupBy("reject_reason").count().collect()} == {"missing": 100, "large": 90}


def test_consolidate_counts_with_its_rows(spark, tmp_path):
    themes = spark.createDataFrame([("a", "1"), ("a", " "), ("b", "2"), (None, "3"), ("c", None)], "code string, valeur string")
    zones = spark.createDataFrame([("a", "A"), ("c", "C")], "code string, nom string")
    rows, seen = census.consolidate(themes, zones)
    with Jobs(spark, "consolidate") as jobs:
        rows.coalesce(1).write.parquet(f"{tmp_path}/rows")
        told = seen.get
    alone = Jobs(spark, "plain")
    with alone:
        themes.join(zones, "code", "left").coalesce(1).write.parquet(f"{tmp_path}/plain")
    assert jobs.count == alone.count and told == {"n0": 1, "n1": 2, "n2": 2}
    assert {(r["outcome"], r["n"]) for r in monitoring.counters(spark, seen, census.OUTCOMES).collect()} == {("kept", 1), ("empty", 2), ("unmatched", 2)}


def test_runs_are_kept(spark, tmp_path):
    log = monitoring.RunLog(spark, f"{tmp_path}/runs")
    with log.run("good") as run:
        run.n_rows = 7
    with pytest.raises(KeyError), log.run("bad"):
        raise KeyError("no such file")
    with pytest.raises(KeyboardInterrupt), log.run("stopped"):
        raise KeyboardInterrupt
    log._append(monitoring.Run("lost"), "killed", datetime.now(UTC), None, "STARTED")  # all that a killed run leaves
    found = {r["load_key"]: (r["status"], r["n_rows"], r["message"]) for r in log.latest().collect()}
    assert found == {"good": ("SUCCESS", 7, None), "bad": ("FAILED", None, "KeyError: 'no such file'"), "stopped": ("FAILED", None, "KeyboardInterrupt: "), "killed": ("RUNNING", None, None)}
    with log.run("bad") as run:
        run.n_rows = 1
    assert {r["load_key"]: r["status"] for r in log.latest().collect()}["bad"] == "SUCCESS"
    assert log.rows().count() == 9 and log.rows().select("run_id").distinct().count() == 5


def test_checks_of_two_runs_are_appended(spark, tmp_path):
    log, df = monitoring.CheckLog(spark, f"{tmp_path}/checks"), spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    for n, rows in enumerate((df, df.where("v IS NOT NULL"))):
        log.append(quality.completeness(rows, "t", ["k", "v"]), monitoring.Run(f"run{n}"))
    assert log.rows().count() == 4
    found = {r["check_name"]: (r["run_id"], r["status"], r["n_runs"], r["n_failed_runs"]) for r in log.latest().collect()}
    assert found == {"k not null": ("run1", "PASS", 2, 0), "v not null": ("run1", "PASS", 2, 1)}


def test_malformed_input_is_kept(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"k": 1, "v": "x"}\n{"k": 2, "v"\n\n{"k": "no number"}\nplain\n{}\n')
    valid, rejects = readers.read_json_kept(spark, f"{tmp_path}/j", "k int, v string")
    assert sorted(map(tuple, valid.select("k", "v").collect()), key=repr) == [(1, "x"), (None, None)]
    assert sorted(r["line"] for r in rejects.collect()) == ["plain", '{"k": "no number"}', '{"k": 2, "v"']
    assert all(r["_source_file"].endswith("a.json") and r["reject_reason"] for r in rejects.collect())
    (tmp_path / "c.csv").write_text('k,v\n1,x\n2\n3,y,z\n"4","two\nlines"\n')
    valid, rejects = readers.read_csv_kept(spark, f"{tmp_path}/c.csv", ["k", "v"])
    assert sorted(map(tuple, valid.select("k", "v").collect())) == [("1", "x"), ("4", "two\nlines")]
    assert sorted(r["line"] for r in rejects.collect()) == ["2", "3,y,z"]


def test_reload_leaves_other_regions_alone(spark, tmp_path):
    rows = spark.range(130).selectExpr("id", "concat('R', lpad(cast(id % 13 as string), 2, '0')) as region")
    sinks.append(rows, f"{tmp_path}/t", ["region"])
    names = lambda: {p.parent.name: sorted(x.name for x in p.parent.glob("*.parquet")) for p in (tmp_path / "t").glob("region=*/*.parquet")}
    before = names()
    sinks.reload_partitions(rows.where("region = 'R04'").selectExpr("-id as id", "region"), f"{tmp_path}/t", ["region"])
    after = names()
    assert len(before) == 13 and {k for k in before if before[k] != after[k]} == {"region=R04"}
    read = readers.read_region(spark, f"{tmp_path}/t", "id long, region string", "region", "R04")
    assert sorted(r["id"] for r in read.collect()) == sorted(-k for k in range(4, 130, 13))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan and "StartsWith(region" in plan


def haversine(lon1, lat1, lon2, lat2):
    h = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("km", [5.0, 120.0, 3000.0, 15000.0])
def test_circles_on_the_sphere(spark, km):
    random.seed(km)
    spots = [(random.uniform(-180, 180), math.degrees(math.asin(random.uniform(-1, 1)))) for _ in range(250)]
    spots += [(random.choice([-180.0, 180.0, 179.99, -179.99, 0.0]), random.uniform(-90, 90)) for _ in range(60)] + [(random.uniform(-180, 180), random.choice([90.0, -90.0, 89.95, 89.9, -89.97])) for _ in range(60)]
    centers = [(180.0, 0.0), (-180.0, 10.0), (10.0, 89.9), (0.0, 90.0), (77.0, -89.9), (179.99, 60.0), (0.0, 0.0), (-120.0, -45.0), *spots[:5], *spots[-5:]]
    p = spark.createDataFrame([(k, *x) for k, x in enumerate(spots)], "p int, lon double, lat double")
    c = spark.createDataFrame([(k, *x) for k, x in enumerate(centers)], "c int, c_lon double, c_lat double")
    found = sorted((r["p"], r["c"]) for r in spatial.within_radius(p, c, km).collect())
    assert found == sorted((i, j) for i, a in enumerate(spots) for j, b in enumerate(centers) if haversine(*a, *b) <= km)


def test_names_of_any_script(spark):
    dim = spark.createDataFrame([(1, "فاس"), (2, "مراكش"), (3, "Москва"), (4, "Fès-Meknès"), (5, "東京"), (6, "Fès فاس"), (7, "***"), (8, None)], "id int, zone string")
    asked = ["فاس", "مراكش", "МОСКВА", "fes  meknes", "東京", "京都", "FES فاس", "—", "", None, "Fès"]
    df = spark.createDataFrame(list(enumerate(asked)), "k int, name string")
    found = {r["k"]: (r["id"], r["reason"]) for r in enrich.match_by_name(df, dim, "name", "zone", "id").collect()}
    absent = (None, "absent")
    assert found == {0: (1, None), 1: (2, None), 2: (3, None), 3: (4, None), 4: (5, None), 5: absent, 6: (6, None), 7: absent, 8: absent, 9: absent, 10: absent}


def test_crowded_cells_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(spatial, "SIDE", 4)
    monkeypatch.setattr(spatial, "BLOCK", 8)
    p = spark.range(90).select(F.col("id").cast("int").alias("p"), F.lit(10.0).alias("lon"), (F.lit(89.9) - F.col("id") % 3 / 10).alias("lat"))
    c = spark.range(40).select(F.col("id").cast("int").alias("c"), F.when(F.col("id") % 2 == 0, 180.0).otherwise(-170.0).alias("c_lon"), F.lit(89.9).alias("c_lat"))
    df = spatial.within_radius(p, c, 40.0)
    rows = df.collect()
    near = {(i, j) for i in range(90) for j in range(40) if haversine(10.0, 89.9 - i % 3 / 10, (180.0, -170.0)[j % 2], 89.9) <= 40}
    assert len(rows) == len(near) and {(r["p"], r["c"]) for r in rows} == near and len(near) >= 2400
    tasks = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 20 and max(r["count"] for r in tasks) < 600


def test_a_point_is_sent_to_few_tasks_however_many_pairs(spark, monkeypatch):
    for name, n in (("SIDE", 4), ("BLOCK", 4), ("TASKS", 25)):
        monkeypatch.setattr(spatial, name, n)
    p = spark.range(400).select(F.col("id").alias("p"), (F.col("id") % 360 - 180.0).alias("lon"), F.lit(89.9).alias("lat"))
    c = spark.range(400).select(F.col("id").alias("c"), (F.col("id") % 7 * 50.0 - 180).alias("c_lon"), F.lit(89.9).alias("c_lat"))
    found = spatial.within_radius(p, c, 40.0).select("p", "c", F.spark_partition_id().alias("task"))
    assert found.select("p", "c").distinct().count() == found.count() == 160_000
    copies = [r["count"] for r in found.select("p", "task").distinct().groupBy("p").count().collect()]
    assert len(copies) == 400 and max(copies) <= 5


def test_pairs_of_a_crowded_cell_take_little_room(spark, tmp_path):
    p = spark.range(2500).select(F.col("id").alias("p"), F.lit(10.0).alias("lon"), (F.lit(89.9) - F.col("id") % 3 / 10).alias("lat"))
    c = spark.range(0, 2501, 1, 1).select(F.col("id").alias("c"), F.lit(180.0).alias("c_lon"), F.lit(89.9).alias("c_lat"))
    spatial.within_radius(p, c, 80.0).select("p", "c").write.parquet(f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2500 * 2501
    assert sum(x.stat().st_size for x in tmp_path.glob("t/*.parquet")) < 0.5 * 2500 * 2501
