"""Literal fixtures for the semantics traps and for defects that were decided on."""

import datetime

import pytest
from pyspark.sql import functions as F

from terrace.functions import casts, geo, text
from terrace.operators import dedup, enrich, incremental, nested, pages, quality, quarantine, topology
from terrace.sources import readers, sinks
from terrace.streaming.upsert import stream_upsert


def values(spark, column, *inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_numbers(spark):
    dirty = ["2,25%", "-", "", None, "1.2.3", "1.0d", "1f", "NaN", "12,5", " 7 ", "1e3", ".5", "5."]
    assert values(spark, casts.to_double_fr, *dirty) == [2.25, None, None, None, None, None, None, None, 12.5, 7.0, 1000.0, 0.5, 5.0]
    assert values(spark, casts.to_double, "12,5", "1.0d", "-3") == [None, None, -3.0]
    assert values(spark, casts.to_int, "12.7", " 12 ", "x", None, "99999999999999999999", "") == [None, 12, None, None, None, None]
    assert values(spark, casts.to_int_fr, "12,5", "1 234", "-", "a-7", None) == [125, 1234, None, -7, None]
    assert values(spark, casts.to_int_fr_strict, "12,5", "1 234") == [None, 1234]
    assert [float(x) if x is not None else None for x in values(spark, casts.placeholder_decimal, "2,5", "-", " ", "x", None)] == [2.5, None, None, None, None]
    assert [tuple(r) for r in values(spark, casts.normalize_number, "2,25%", "1 234", "1,5", "n/a", "'7'")] == [(None, 2.25, None), (1234, None, None), (None, 1.5, None), (None, None, "n/a"), (7, None, None)]
    assert values(spark, casts.unit_or_one, "x 100", "none", None) == [100, 1, 1]


def test_dates(spark):
    d = datetime.date
    assert values(spark, casts.to_date_fr, "1/2/2026", "31/02/2026", "01/02/2026 x", None, " 3/4/2025 ") == [d(2026, 2, 1), None, None, None, d(2025, 4, 3)]
    assert values(spark, casts.to_date_period, "02-2026", "13-2026", "2-2026", None) == [d(2026, 2, 1), None, None, None]


def test_text(spark):
    assert values(spark, text.normalize_name, "  Aït-Mélloul   Sud ", "ÉCOLE", "œuf") == ["ait melloul sud", "ecole", "uf"]
    assert values(spark, text.fold_header, "  L’Été\n x ", None) == ["l'ete x", ""]
    assert values(spark, text.field_name, "Rayon", "Localité", "%", "", "Nombre de guichets", None) == ["rayon_action", "localite", "percent", "column", "nombre_de_guichets", "column"]
    assert values(spark, text.period_from_title, "Dépôts 12-2025", "Rapport 2024", "03/2020 x", "none") == ["12-2025", "2024", "03-2020", None]
    assert values(spark, text.quantity, "100 YEN", "1 000 X", "EURO") == ["100", "1000", "1"]
    assert values(spark, text.quantity_label, "100 YEN", "EURO") == ["YEN", "EURO"]
    assert values(spark, text.split_types, "a|b", " ", None) == [["a", "b"], None, None]
    assert values(spark, text.clean_address, " 12, rue  *Été*!  #3 ", "J94J+J8") == ["12, rue Été #3", "J94J+J8"]
    assert values(spark, text.identifier, "1 a b", "__", "ok") == ["t_1_a_b", "column", "ok"]
    assert values(spark, text.to_tags, '{"a":"b"}', " ") == [{"a": "b"}, None]
    assert values(spark, text.nfkc, " ﬁn ①", None) == ["fin 1", None]


def test_colliding_labels_keep_the_last(spark):
    m = F.map_from_arrays(F.array(F.lit("Ville"), F.lit("Commune")), F.array(F.lit("a"), F.lit("b")))
    assert spark.range(1).select(text.normalize_map(m)).first()[0]["localite"].asDict() == {"i": None, "d": None, "s": "b"}


def test_split_is_complementary(spark):
    df = spark.createDataFrame([(91.0, 1.0), (None, 2.0), (3.0, None), (4.0, -181.0), (5.0, 6.0)], "lat double, lon double")
    rules = [quarantine.in_range("lat", -90, 90), quarantine.in_range("lon", -180, 180)]
    valid, rejects = quarantine.split(df, rules)
    assert valid.count() + rejects.count() == df.count() and valid.count() == 1
    assert [r[0] for r in rejects.orderBy("reject_reason").select("reject_reason").collect()] == ["lat out of range"] * 2 + ["lon out of range"] * 2


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([("a", None, 1), ("b", "p", 2)], "k string, period string, v int")
    new = spark.createDataFrame([("a", None, 9), ("a", None, 8), ("c", "p", 3)], "k string, period string, v int")
    once = sinks.upsert_update(old, new, ["k", "period"], [F.desc("v")])
    twice = sinks.upsert_update(once, new, ["k", "period"], [F.desc("v")])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str) == [("a", None, 9), ("b", "p", 2), ("c", "p", 3)]
    assert sinks.upsert_ignore(old, new, ["k", "period"], [F.desc("v")]).count() == 3


def test_surrogate_keys_have_no_gap(spark):
    ids = [tuple(r) for r in sinks.surrogate_key(spark.range(0, 1000, 1, 7).withColumn("k", -F.col("id")), ["k"], "n").orderBy("n").select("k", "n").collect()]
    assert ids == [(-999 + i, i + 1) for i in range(1000)]


def test_ragged(spark):
    df = spark.createDataFrame([(1, {"a": "1", "b": "x"}), (2, {"a": "2", "c": "1.5"}), (3, {})], "id int, data map<string,string>")
    wide = sinks.spread_ragged(df, ["id"])
    assert wide.columns == ["id", "a", "b", "c"]
    kinds = {r[0]: r[1] for r in sinks.ragged_types(wide, ["a", "b", "c"]).collect()}
    assert kinds == {"a": "INTEGER", "b": "TEXT", "c": "REAL"}
    assert dict(sinks.typed(wide, kinds).dtypes) == {"id": "int", "a": "bigint", "b": "string", "c": "double"}


def test_csv_keeps_all_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text('h1,h2\r\n"a ""q"" , b",\r\n"two\nlines",2\r\n', encoding="utf-8", newline="")
    rows = sorted(map(tuple, readers.read_text_csv(spark, str(tmp_path / "x.csv"), ["k", "v"]).collect()))
    assert rows == [('a "q" , b', None), ("two\nlines", "2")]


def ring(*points):
    return [{"lon": float(a), "lat": float(b)} for a, b in points]


def geom(spark, *rings):
    return spark.createDataFrame([([list(rings)],)], f"geom array<array<array<{geo.POINT}>>>")


@pytest.mark.parametrize(
    ("points", "problem"),
    [([(0, 0), (4, 0), (4, 4), (0, 0)], None), ([(0, 0), (4, 0), (4, 4), (0, 4)], "open_ring"), ([(0, 0), (4, 4), (4, 0), (0, 5), (0, 0)], "self_crossing"), ([(0, 0), (1, 1), (0, 0)], "too_few_points"), ([(0, 0), (200, 0), (1, 1), (0, 0)], "out_of_range"), ([(0, 0), (1, 1), (2, 2), (0, 0)], "no_area")],
)
def test_rings(spark, points, problem):
    assert topology.geometry_problems(geom(spark, ring(*points)).withColumn("k", F.lit(1)), ["k"]).first()["problem"] == problem


def test_hole_is_outside(spark):
    polygons = geom(spark, ring((0, 0), (9, 0), (9, 9), (0, 9), (0, 0)), ring((3, 3), (6, 3), (6, 6), (3, 6), (3, 3))).withColumn("n", F.lit(1))
    points = spark.createDataFrame([(1.0, 1.0), (4.0, 4.0), (8.5, 8.5), (10.0, 1.0), (0.0, 0.0)], "lon double, lat double")
    found = sorted(tuple(r)[:2] for r in topology.points_in_polygons(points, polygons, 2.0).collect())
    assert found == [(0.0, 0.0), (1.0, 1.0), (8.5, 8.5)]


def test_short_names_match_prefixes(spark):
    zones = spark.createDataFrame([("A%", 1), ("Fès", 1), ("X", 1), ("", 1)], "zone string, lvl int")
    places = spark.createDataFrame([(1, 1, "Fes Medina"), (2, 1, "fès"), (3, 2, "Fes"), (4, 1, "Xauen")], "id int, lvl int, name string")
    found = {r["zone"]: r["matched_id"] for r in enrich.prefix_match(zones, places, "zone", "name", "lvl", "id").collect()}
    assert found == {"A%": None, "Fès": 2, "X": 4, "": None}


def test_html_round_trip(spark):
    cells = [["a & b", "<x>", ""], ["é", "1,5", "two\nlines"]]
    body = "".join("<tr>" + "".join(f"<td>{c.replace('&', '&amp;').replace('<', '&lt;').replace(chr(10), '<br/>')}</td>" for c in row) + "</tr>" for row in cells)
    df = spark.createDataFrame([(1, f"<p>x<table>{body}</table>"), (2, None)], "page_id long, html string")
    assert [r["grid"] for r in pages.extract_html_tables(df).collect()] == [cells]


def test_pivot_and_back(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "k string, n string, v int")
    wide = nested.pivot_series(df, ["k"], "n", ["x", "y"], F.max("v"))
    assert sorted(map(tuple, nested.unpivot_series(wide, ["k"], ["x", "y"], "n", "v").collect())) == sorted(map(tuple, df.collect()))


def test_first_and_latest(spark):
    df = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("v", 1, "c")], "url string, pos int, t string")
    assert sorted(map(tuple, dedup.first_by(df, ["url"], ["pos"]).collect())) == [("u", 1, "a"), ("v", 1, "c")]
    assert sorted(map(tuple, dedup.dedup_latest(df, ["url"], [F.desc("pos")]).collect())) == [("u", 2, "b"), ("v", 1, "c")]


def test_unchanged_pages(spark):
    pages_ = spark.createDataFrame([("u", "a"), ("v", None), ("w", "b")], "url string, html string")
    state = incremental.detect_changes(pages_, spark.createDataFrame([], "url string, content_sha256 string")).select("url", "content_sha256")
    again = pages_.withColumn("html", F.when(F.col("url") == "w", "c").otherwise(F.col("html")))
    assert {r["url"]: r["status"] for r in incremental.detect_changes(again, state).collect()} == {"u": "UNCHANGED", "v": "UNCHANGED", "w": "NEW"}


def test_pages_of_one_address(spark):
    """Each page is compared with its own state; missing content has no hash."""
    pages_ = spark.createDataFrame([(1, "u", "a"), (2, "u", "b"), (3, "u", None), (4, "u", None)], "page_id int, url string, html string")
    state = incremental.detect_changes(pages_.where("page_id < 4"), pages_.limit(0).withColumn("content_sha256", F.lit("")), ["page_id", "url"]).drop("status")
    again = incremental.detect_changes(pages_.withColumn("html", F.when(F.col("page_id") == 2, "a").otherwise(F.col("html"))), state, ["page_id", "url"])
    rows = sorted(map(tuple, again.select("page_id", "url", F.col("content_sha256").isNull(), "status").collect()))
    assert rows == [(1, "u", False, "UNCHANGED"), (2, "u", False, "NEW"), (3, "u", True, "UNCHANGED"), (4, "u", True, "NEW")]


def test_hash_change_with_addresses_twice(spark, tmp_path):
    from terrace.plans.catalog import QUERIES

    spark.range(1, 41).selectExpr("id AS page_id", "concat('u', id % 7) AS url", "if(id % 5 = 0, NULL, concat('h', id)) AS html").write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["hash_change"](spark, str(tmp_path)).groupBy("status").count().collect()
    new = sum(k % 4 == 0 or k % 9 == 0 for k in range(1, 41))
    assert {r["status"]: r["count"] for r in found} == {"NEW": new, "UNCHANGED": 40 - new}


def test_checks_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, v int")
    assert [r["status"] for r in quality.completeness(empty, "t", ["k", "v"]).collect()] == ["PASS", "PASS"]
    assert quality.uniqueness(empty, "t", ["k"]).first()["status"] == "PASS"
    assert quality.coverage(empty, "t", "v").first()["status"] == "PASS"


def test_stream_in_any_order(spark, tmp_path):
    schema = "k int, v int, version int"
    rows = [[(1, 10, 1), (2, 20, 1)], [(1, 11, 2), (None, 0, 1)], [(3, 30, 1), (1, 9, 0)]]
    results = []
    for run, order in enumerate(([0, 1, 2], [2, 1, 0])):
        base = tmp_path / str(run)
        for k in order:
            df = spark.createDataFrame(rows[k], schema)
            df.coalesce(1).write.mode("append").parquet(f"{base}/landing")
            out = stream_upsert(spark, f"{base}/landing", df.schema, f"{base}/table", f"{base}/state", ["k"], "version", [("key missing", F.col("k").isNotNull())])
        results.append(sorted(map(tuple, out.select("k", "v", "version").collect())))
    assert results[0] == results[1] == [(1, 11, 2), (2, 20, 1), (3, 30, 1)]


def test_stream_adds_runs(spark, tmp_path):
    schema = "k int, v int, version int"
    (tmp_path / "landing").mkdir()
    args = (f"{tmp_path}/table", f"{tmp_path}/state", ["k"], "version")
    shape = spark.createDataFrame([], schema).schema
    none = stream_upsert(spark, f"{tmp_path}/landing", shape, *args)
    assert none.count() == 0 and none.columns == ["k", "v", "version"]
    for n, rows in enumerate([[(k, k, 1) for k in range(100)], [(7, 70, 2)], [(7, 71, 2)], [(7, 0, 1), (None, 5, 1)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landing")
        out = stream_upsert(spark, f"{tmp_path}/landing", shape, *args)
        run = spark.read.parquet(f"{tmp_path}/table/run-{n + 1:012d}")
        assert run.count() == len(rows)  # the batch alone
    found = {r["k"]: r["v"] for r in out.collect()}
    assert found == {k: k for k in range(100)} | {7: 71, None: 5}
    again = stream_upsert(spark, f"{tmp_path}/landing", shape, *args)
    assert len([*(tmp_path / "table").glob("run-*")]) == 4 and again.count() == 101
    with pytest.raises(ValueError, match="was written as"):
        stream_upsert(spark, f"{tmp_path}/landing", shape, f"{tmp_path}/table", f"{tmp_path}/state", ["k", "v"], "version")


def test_header_rules_follow_the_slug(spark):
    """All rules as they apply to slugs: words joined by underscores are one word, so patterns of several words find nothing."""
    import re

    labels = ["Code rayon action", "Rayon", "rayon d'action", "Localité", "Ville", "COMMUNE", "Code localité", "Nombre guichet", "Guichet", "Dépôts", "Dépôt montant", "dépôts %", "Crédit montant", "Immobilier", "Équipement", "Trésorerie", "Consommation", "Ménage", "Ménages", "Sociétés non financières privées", "Entreprise", "Entreprises", "%", "Variation %", "Encours variation", "Autre"]
    found = values(spark, text.field_name, *labels)
    slugs = values(spark, text.slug, *labels)
    assert found == [next((name for pattern, name in text.FIELD_RULES if re.search(pattern, s, re.ASCII)), s) for s in slugs]
    assert {"rayon_action", "localite", "nombre_guichets", "credit_immobilier", "credit_equipement", "credit_tresorerie", "credit_consommation", "credit_menages", "credit_entreprises", "percent"} <= set(found)


def test_load_log_of_long_histories(spark):
    rows = [("a", f"2026-01-{k:02d} 00:00:00", None, None, None, None) for k in range(1, 29)] + [("a", None, f"2026-01-{k:02d} 01:00:00", "OK", k, None) for k in range(1, 29)] + [("b", "2026-02-01 00:00:00", None, None, None, None), ("c", None, "2026-02-01 00:00:00", "OK", 1, None)]
    df = spark.createDataFrame(rows, "load_key string, started_at string, ended_at string, status string, n_rows int, message string").withColumns({c: F.col(c).cast("timestamp") for c in ("started_at", "ended_at")})
    found = {r["load_key"]: (r["status"], r["n_rows"], r["duration_ms"]) for r in quality.load_log(df).collect()}
    assert found == {"a": ("OK", 28, 3_600_000), "b": ("RUNNING", None, None)}


def test_point_in_two_parts_is_one_match(spark):
    ring = lambda x, y: [[(x, y), (x + 4.0, y), (x + 4.0, y + 4.0), (x, y + 4.0), (x, y)]]
    polygons = spark.createDataFrame([(1, [ring(0.0, 0.0), ring(2.0, 2.0)])], "id int, geom array<array<array<struct<lon:double,lat:double>>>>")
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 1.0, 1.0), (3, 5.5, 5.5), (4, 9.0, 9.0)], "p int, lon double, lat double")
    assert sorted(r["p"] for r in topology.points_in_polygons(points, polygons, 1.0).collect()) == [1, 2, 3]


def test_labels_are_worked_out_once(spark):
    m = text.normalize_map(F.map_from_arrays(F.array(F.lit("Ville"), F.lit("Rayon"), F.lit("Commune")), F.array(F.lit("?"), F.lit("7 %"), F.lit("Fès"))))
    assert spark.range(1).select(m.alias("m"))._jdf.queryExecution().analyzed().toString().count("[^a-z0-9]+") == 1
    found = spark.range(1).select(m.alias("m")).first()["m"]
    assert [(k, v["i"], v["d"], v["s"]) for k, v in found.items()] == [("localite", None, None, "Fès"), ("rayon_action", None, 7.0, None)]


def test_variants_are_asked_by_few_ranges(spark):
    import re

    plan = spark.range(1).select(casts.compat(F.concat("id", F.lit("é"))).alias("x"))._jdf.queryExecution().analyzed().toString()
    classes = re.findall(r"RLIKE\((?:.*?), (\[[^\]]*\])\)| RLIKE (\[[^\]]*\])", plan)
    assert classes and all(len(re.findall(r"\\x\{\w+\}-\\x\{\w+\}|[^\[\]]", a or b)) <= 10 for a, b in classes)
    variants = [*casts._FORMS, *(c for c, _ in casts._LIGATURES)]
    expected = [*casts._PLAIN, *(plain for _, plain in casts._LIGATURES)]
    df = spark.createDataFrame([(k, f"é{c}b") for k, c in enumerate(variants)], "k int, x string")
    assert {r["k"]: r["x"] for r in df.select("k", casts.compat(F.col("x")).alias("x")).collect()} == {k: f"é{c}b" for k, c in enumerate(expected)}


def test_measures_of_the_root_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(enrich, "CROWD", 10)
    measures = spark.range(100).select("id", F.when(F.col("id") < 70, "MA").when(F.col("id") < 80, F.col("id").cast("string")).when(F.col("id") < 90, "?").alias("code"))
    zones = spark.createDataFrame([(str(k), f"z{k}") for k in range(70, 79)] + [("75", "again")], "code string, zone string")
    known, unknown = enrich.enrich_with_root(measures, zones, spark.createDataFrame([("MA", "root")], "code string, zone string"), "code")
    assert known.columns == ["code", "id", "zone"] and unknown.columns == ["code", "id"]
    assert sorted((r["id"], r["zone"]) for r in known.collect()) == sorted([(k, "root") for k in range(70)] + [(k, f"z{k}") for k in range(70, 79)] + [(75, "again")])
    assert sorted(r["id"] for r in unknown.collect()) == list(range(79, 100))
    assert "_task" in known._jdf.queryExecution().executedPlan().toString()
