"""Queries of the source jobs: bronze tables are rendered from the driver's tables, gold and rejects come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.jobs import census, listings, pois, rates
from terrace.operators import monitoring
from terrace.plans.registry import french, query, table, text2
from terrace.sources import sinks
from terrace.sources.storage import shared_path


def _key(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _zones(spark, d):
    def rows(t, niveau, nom, region, province, commune, lon):
        return t.select(F.lit(niveau).alias("niveau"), nom.alias("nom"), F.lit("MA").alias("code_pays"), region.alias("code_region"), province.alias("code_province"), commune.alias("code_commune"), lon.alias("centroid_lon"), F.lit("30.5").alias("centroid_lat"))

    none = F.lit("")
    nations = table(spark, d, "nation")
    a = rows(table(spark, d, "region"), "region", F.col("r_name"), _key("R", "r_regionkey"), none, none, F.lit("-7"))
    b = rows(nations, "province", F.col("n_name"), _key("R", "n_regionkey"), _key("N", "n_nationkey"), none, F.when(F.col("n_nationkey") % 6 == 0, "n/a").otherwise(F.col("n_nationkey").cast("string")))
    s = table(spark, d, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    c = rows(s, "commune", F.when(F.col("s_suppkey") % 10 == 0, "Sebta").otherwise(F.col("s_name")), _key("R", "n_regionkey"), _key("N", "s_nationkey"), _key("S", "s_suppkey"), F.lit("1.5"))
    return a.unionByName(b).unionByName(c)


def _indicators(spark, d):
    n = F.col("l_linenumber")
    code = F.when(n == 7, "ZZ").when(n == 1, "MA").otherwise(_key("S", "l_suppkey"))
    value = F.when(n == 5, "1.2.3").otherwise(text2("l_quantity"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", code.alias("code"), F.lit("t").alias("theme"), F.when(n == 2, "").otherwise(F.col("l_linestatus")).alias("milieu"), F.lit("").alias("sexe"), F.when(n == 6, " ").otherwise(F.col("l_returnflag")).alias("indicateur"), value.alias("valeur"))


def _census(spark, d):
    nation = table(spark, d, "nation")
    boundaries = nation.select(_key("b", "n_nationkey").alias("osm_id"), F.concat("n_name", F.lit(" Province")).alias("name"), F.lit("province").alias("niveau"))
    return census.run(_indicators(spark, d), _zones(spark, d), boundaries)


_CODED = "SELECT *, CASE l_linenumber WHEN 7 THEN 'ZZ' WHEN 1 THEN 'MA' ELSE 'S' || l_suppkey END AS code, l_linenumber = 1 OR (l_linenumber <> 7 AND l_suppkey IN (SELECT s_suppkey FROM supplier)) AS known FROM lineitem"


@query(f"""SELECT l_orderkey, l_linenumber, code, CASE WHEN l_linenumber <> 2 THEN l_linestatus END AS milieu, l_returnflag AS indicateur, CAST(CAST(l_quantity AS DECIMAL(14,2)) AS DECIMAL(38,6)) AS valeur
FROM ({_CODED}) WHERE known AND l_linenumber NOT IN (5, 6) AND (l_linenumber = 1 OR l_suppkey % 10 <> 0)""")
def job_census_facts(spark, d):
    return _census(spark, d)["fact_indicateurs"].select("l_orderkey", "l_linenumber", "code", "milieu", "indicateur", "valeur")


@query(f"""SELECT l_orderkey, l_linenumber, code, CASE WHEN NOT known THEN 'code_zone_inconnu' WHEN l_linenumber = 6 THEN 'indicateur_vide' ELSE 'valeur_non_numerique' END AS reject_reason FROM ({_CODED}) WHERE NOT known OR l_linenumber IN (5, 6)""")
def job_census_rejects(spark, d):
    return _census(spark, d)["rejects"].select("l_orderkey", "l_linenumber", "code", "reject_reason")


@query("""SELECT 'R' || r_regionkey AS code, 'region' AS niveau, r_name AS nom, TRUE AS has_geom, NULL AS boundary_id FROM region
UNION ALL SELECT 'N' || n_nationkey, 'province', n_name, n_nationkey % 6 <> 0, 'b' || n_nationkey FROM nation
UNION ALL SELECT 'S' || s_suppkey, 'commune', s_name, TRUE, NULL FROM supplier WHERE s_suppkey % 10 <> 0 UNION ALL SELECT 'MA', 'pays', 'Maroc', FALSE, NULL""")
def job_census_zones(spark, d):
    return _census(spark, d)["dim_census_zone"].select("code", "niveau", "nom", F.col("geom").isNotNull().alias("has_geom"), "boundary_id")


@query(f"""WITH f AS (SELECT DISTINCT l_suppkey FROM ({_CODED}) WHERE known AND l_linenumber NOT IN (1, 5, 6)), c AS (SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 <> 0),
z AS (SELECT (SELECT count(*) FROM c) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM region) + 1 AS n), g AS (SELECT count(*) + 1 AS m FROM nation WHERE n_nationkey % 6 = 0)
SELECT 'dim_census_zone' AS table_name, 'code not null' AS check_name, 'PASS' AS status, CAST(0 AS BIGINT) AS n_failing, n AS n_total FROM z
UNION ALL SELECT 'dim_census_zone', 'nom not null', 'PASS', 0, n FROM z
UNION ALL SELECT 'dim_census_zone', 'geom coverage', CASE WHEN m = 0 THEN 'PASS' WHEN m < n * 0.25 THEN 'WARN' ELSE 'FAIL' END, m, n FROM z, g
UNION ALL SELECT 'dim_census_zone', 'code unique', 'PASS', 0, n FROM z
UNION ALL SELECT 'fact_indicateurs', 'code has children', CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END, m, n FROM (SELECT count(*) AS n, count(*) FILTER (s_suppkey NOT IN (SELECT l_suppkey FROM f)) AS m FROM c)""")
def job_census_checks(spark, d):
    return _census(spark, d)["checks"]


@query("""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN l_linenumber = 2 THEN 'empty' WHEN l_suppkey % 10 = 0 OR l_suppkey NOT IN (SELECT s_suppkey FROM supplier) THEN 'unmatched' ELSE 'kept' END AS outcome FROM lineitem) GROUP BY outcome""")
def job_consolidate(spark, d):
    zones = table(spark, d, "supplier").where("s_suppkey % 10 <> 0").select(_key("S", "s_suppkey").alias("code"), F.col("s_name").alias("nom"))
    themes = table(spark, d, "lineitem").select(_key("S", "l_suppkey").alias("code"), F.when(F.col("l_linenumber") == 2, " ").otherwise(text2("l_tax")).alias("valeur"))
    rows, seen = census.consolidate(themes, zones)
    sinks.full_load(rows, shared_path(spark, "consolidated"))
    return monitoring.counters(spark, seen, census.OUTCOMES)


def _rates(spark, d):
    k = F.col("o_orderkey")
    code = F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit("C"), (F.col("o_custkey") % 50).cast("string")))
    price = F.when(k % 5 == 0, "-").when(k % 7 == 0, "abc").otherwise(french("o_totalprice"))
    day = F.when(k % 13 == 0, "31/02/2026").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    orders = table(spark, d, "orders")
    bronze = orders.select("o_orderkey", code.alias("devise_code"), F.lit("devise ").alias("devise_libelle"), F.lit("x 100").alias("unite"), day.alias("date_cours"), price.alias("cours_moyen"))
    decisions = orders.select(F.date_format("o_orderdate", "d/M/yyyy").alias("date_decision"), F.lit("2,25%").alias("taux_directeur"), F.lit("-").alias("ratio_reserve_obligatoire"))
    return rates.run(bronze, decisions)


_RATE = "SELECT 'C' || (o_custkey % 50) AS devise_code, CAST(o_orderdate AS DATE) AS date_id, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS cours_moyen FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0"


@query(f"SELECT devise_code, date_id, max(cours_moyen) AS cours_moyen FROM ({_RATE}) GROUP BY ALL")
def job_rates_facts(spark, d):
    return _rates(spark, d)["fact_taux_change"].select("devise_code", "date_id", "cours_moyen")


@query("""SELECT reject_reason, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'devise_code manquant' WHEN o_orderkey % 13 = 0 THEN 'date_cours invalide (attendu JJ/MM/AAAA)'
WHEN o_orderkey % 5 = 0 THEN 'cours_moyen absent' WHEN o_orderkey % 7 = 0 THEN 'cours_moyen non numerique' END AS reject_reason FROM orders) WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")
def job_rates_rejects(spark, d):
    return _rates(spark, d)["rejects"].groupBy("reject_reason").agg(F.count("*").alias("n"))


@query(f"""WITH x AS (SELECT date_id FROM ({_RATE}) UNION SELECT CAST(o_orderdate AS DATE) FROM orders)
SELECT date_id, CAST(year(date_id) AS INT) AS annee, CAST(month(date_id) AS INT) AS mois, CAST(quarter(date_id) AS INT) AS trimestre FROM x""")
def job_rates_dates(spark, d):
    return _rates(spark, d)["dim_date"].drop("libelle_mois")


@query("""WITH r AS (SELECT 'rayon_action' AS g, 'R' || r_regionkey AS code, 1 AS n, CAST(r_regionkey AS DOUBLE) AS amount FROM region), l AS (SELECT 'localite' AS g, 'L' || s_suppkey AS code, 2 AS n, CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS DOUBLE) AS amount FROM supplier),
u AS (SELECT * FROM r UNION ALL SELECT * FROM l) SELECT DATE '2025-12-01' AS periode_id, CAST(row_number() OVER (ORDER BY g, code) AS BIGINT) AS zone_id, CAST(n AS BIGINT) AS nombre_guichets, amount AS depots_montant FROM u""")
def job_credit_facts(spark, d):
    """Deposits of two grains of zones with keys numbered over both."""
    def bronze(t, code, label, branches, amount):
        return t.select(code.alias("code"), label.alias("label"), F.lit("12-2025").alias("periode"), F.lit(branches).alias("nombre_guichets"), amount.alias("depots_montant"), *(F.lit("-").alias(c) for c in ("depots_percent", "credits_montant", "credits_percent")))

    regional = bronze(table(spark, d, "region"), _key("R", "r_regionkey"), F.col("r_name"), "1 guichet", F.col("r_regionkey").cast("string"))
    local = bronze(table(spark, d, "supplier"), _key("L", "s_suppkey"), F.col("s_name"), "2 guichets", french("s_acctbal"))
    grains = {g: rates.silver_credit(b, "code", "label").where("reject_reason IS NULL").drop("reject_reason") for g, b in (("rayon_action", regional), ("localite", local))}
    return rates.credit_facts(grains, rates.dim_zone(grains)).select("periode_id", "zone_id", "nombre_guichets", "depots_montant")


def _pois(spark, d):
    k = F.col("o_orderkey")
    bronze = table(spark, d, "orders").select(
        F.concat(F.lit("Z"), (F.col("o_custkey") % 25).cast("string")).alias("commune_code"), F.lit("zone").alias("commune_nom"),
        F.when(k % 13 == 0, "x1").otherwise((k % 5000).cast("string")).alias("osm_id"),
        F.when(k % 17 == 0, "blob").when(k % 3 == 0, "node").when(k % 3 == 1, "way ").otherwise("relation").alias("osm_type"),
        F.when(k % 19 == 0, "91").otherwise((F.col("o_custkey") % 90).cast("string")).alias("lat"), F.when(k % 23 == 0, "-181").otherwise("1.5").alias("lon"),
        F.when(k % 29 == 0, " ").otherwise(F.col("o_orderstatus")).alias("category_key"), F.col("o_orderpriority").alias("category_value"), F.lit("").alias("poi_name"), F.lit('{"name":"x"}').alias("tags_json"), F.col("o_orderdate").alias("_ingested_at"),
    )
    zones = table(spark, d, "nation").where("n_nationkey <> 3").select(_key("Z", "n_nationkey").alias("code"), F.col("n_name").alias("nom"))
    return pois.run(bronze, zones)


_POI = """SELECT *, CASE WHEN o_orderkey % 13 = 0 THEN 'osm_id manquant/non numerique' WHEN o_orderkey % 17 = 0 THEN 'osm_type invalide' WHEN o_orderkey % 19 = 0 THEN 'lat invalide' WHEN o_orderkey % 23 = 0 THEN 'lon invalide'
WHEN o_orderkey % 29 = 0 THEN 'category_key manquante' END AS reject_reason, 'Z' || (o_custkey % 25) AS commune_code FROM orders"""


@query(f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey % 5000, o_orderkey % 3 ORDER BY o_orderdate DESC, o_orderstatus, o_orderpriority, commune_code) AS k FROM ({_POI}) WHERE reject_reason IS NULL),
g AS (SELECT commune_code, 'zone' AS commune_nom, o_orderstatus AS category_key, count(*) AS nb_pois FROM p WHERE k = 1 GROUP BY ALL)
SELECT g.*, n_name AS zone_nom FROM g LEFT JOIN nation ON commune_code = 'Z' || n_nationkey AND n_nationkey <> 3""")
def job_poi_counts(spark, d):
    return _pois(spark, d)["poi_counts"]


@query(f"SELECT reject_reason, count(*) AS n FROM ({_POI}) WHERE reject_reason IS NOT NULL GROUP BY reject_reason")
def job_poi_rejects(spark, d):
    return _pois(spark, d)["rejects"].groupBy("reject_reason").agg(F.count("*").alias("n"))


def _listings(spark, d):
    k = F.col("c_custkey")
    bronze = table(spark, d, "customer").select(
        _key("Z", "c_nationkey").alias("commune_code"), F.lit("zone").alias("commune_nom"), F.col("c_mktsegment").alias("category"),
        F.when(k % 13 == 0, " ").otherwise(F.concat(F.lit("P"), (k % 1000).cast("string"))).alias("place_id"), F.col("c_name").alias("display_name"), F.lit("a|b").alias("types"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 11 == 0, "91").when(k % 17 == 0, "1.2.3").otherwise(F.col("c_nationkey").cast("string")).alias("lat"), F.lit("-7.5").alias("lon"),
        F.when(k % 3 == 0, "").otherwise((k % 50 / 10).cast("decimal(4,2)").cast("string")).alias("rating"), F.lit("12").alias("user_rating_count"),
    )
    zones = table(spark, d, "nation").where("n_nationkey <> 3").select(_key("Z", "n_nationkey").alias("code"), F.col("n_name").alias("nom"))
    return listings.run(bronze, zones)


_PLACE = "SELECT *, CASE WHEN c_custkey % 13 = 0 THEN 'place_id_manquant' WHEN c_custkey % 7 = 0 OR (c_custkey % 11 <> 0 AND c_custkey % 17 = 0) THEN 'lat_lon_non_numerique' WHEN c_custkey % 11 = 0 THEN 'lat_hors_plage' END AS reject_reason, CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 50) * 10 END AS cents FROM customer"


@query(f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY c_custkey % 1000, c_mktsegment ORDER BY cents DESC NULLS LAST, c_name, 'Z' || c_nationkey) AS k FROM ({_PLACE}) WHERE reject_reason IS NULL),
g AS (SELECT c_nationkey, c_mktsegment AS category, count(*) AS nb_places, CAST(sum(cents) AS BIGINT) AS s, count(cents) AS n FROM p WHERE k = 1 GROUP BY ALL)
SELECT 'Z' || c_nationkey AS commune_code, 'zone' AS commune_nom, category, nb_places, CASE WHEN n > 0 THEN CAST(sign(s) * ((2 * abs(s) + n) // (2 * n)) AS DOUBLE) / 100 END AS note_moyenne, n_name AS zone_nom
FROM g LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey <> 3""")
def job_listings_by_zone(spark, d):
    return _listings(spark, d)["places_by_zone"]


@query(f"SELECT reject_reason, count(*) AS n FROM ({_PLACE}) WHERE reject_reason IS NOT NULL GROUP BY reject_reason")
def job_listings_rejects(spark, d):
    return _listings(spark, d)["rejects"].groupBy("reject_reason").agg(F.count("*").alias("n"))


@query("""WITH n AS (SELECT n_nationkey, CAST(n_nationkey % 5 * 10 AS DOUBLE) AS x, CAST(n_nationkey // 5 * 10 AS DOUBLE) AS y FROM nation), p AS (SELECT c_custkey, CAST(c_custkey * 37 % 1000 AS DOUBLE) / 20.0 - 0.013 AS lon, CAST(c_custkey * 91 % 1000 AS DOUBLE) / 20.0 - 0.007 AS lat FROM customer)
SELECT c_custkey AS osm_id, 'b' || n_nationkey AS zone_osm_id FROM p LEFT JOIN n ON lon - x BETWEEN 0 AND 9 AND lat - y BETWEEN 0 AND 9""")
def job_assign_points(spark, d):
    """Boundaries as GeoJSON text, cleaned and checked, then points assigned to them."""
    x, y = (F.col("n_nationkey") % 5 * 10), F.floor(F.col("n_nationkey") / 5) * 10
    corner = lambda a, b: F.concat(F.lit("["), (x + a).cast("string"), F.lit(","), (y + b).cast("string"), F.lit("]"))
    ring = F.concat(F.lit('{"type":"Polygon","coordinates":[['), F.concat_ws(",", corner(0, 0), corner(9, 0), corner(9, 9), corner(0, 9)), F.lit("]]}"))  # left open
    bronze = table(spark, d, "nation").select(_key("b", "n_nationkey").alias("osm_id"), ring.alias("geojson_geom"))
    boundaries = pois.silver_boundaries(bronze).where("reject_reason IS NULL")
    points = table(spark, d, "customer").select(F.col("c_custkey").alias("osm_id"), F.lit("node").alias("osm_type"), (F.col("c_custkey") * 37 % 1000 / 20.0 - 0.013).alias("lon"), (F.col("c_custkey") * 91 % 1000 / 20.0 - 0.007).alias("lat"))
    return pois.assign(points, boundaries, 5.0).select("osm_id", "zone_osm_id")
