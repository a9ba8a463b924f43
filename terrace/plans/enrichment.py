"""Queries of name and spatial enrichment, nested data, raw pages and grids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.functions import casts, geo, text
from terrace.operators import enrich, nested, pages, quality, spatial, topology
from terrace.plans.registry import query, table, text2


@query("""WITH b AS (SELECT p_partkey AS id, p_size % 3 AS lvl, p_brand || ' ' || p_type AS name FROM part),
z AS (SELECT s_suppkey, CAST(s_suppkey % 3 AS INT) AS lvl, CASE WHEN s_suppkey % 4 = 0 THEN 'Br' WHEN s_suppkey % 4 = 1 THEN 'BRAND#1' WHEN s_suppkey % 4 = 2 THEN 'Bránd#2' ELSE 'X%' END AS name FROM supplier),
m AS (SELECT s_suppkey, id, b.name, row_number() OVER (PARTITION BY s_suppkey ORDER BY length(trim(b.name)), id) AS k FROM z JOIN b ON z.lvl = b.lvl AND starts_with(lower(b.name), strip_accents(lower(z.name))))
SELECT z.s_suppkey, z.name AS zone_name, m.id AS matched_id, m.name AS matched_name FROM z LEFT JOIN m ON z.s_suppkey = m.s_suppkey AND k = 1""")
def prefix_enrich(spark, d):
    k = F.col("s_suppkey") % 4
    zones = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 3).cast("int").alias("lvl"), F.when(k == 0, "Br").when(k == 1, "BRAND#1").when(k == 2, "Bránd#2").otherwise("X%").alias("zone_name"))
    places = table(spark, d, "part").select("p_partkey", (F.col("p_size") % 3).alias("lvl"), F.concat_ws(" ", "p_brand", "p_type").alias("name"))
    return enrich.prefix_match(zones, places, "zone_name", "name", "lvl", "p_partkey").drop("lvl")


@query("""WITH n AS (SELECT lower(CASE WHEN n_nationkey IN (3, 4) THEN 'twin' ELSE n_name END) AS f, min(n_nationkey) AS id, count(*) AS c FROM nation GROUP BY 1),
s AS (SELECT s_suppkey, lower(CASE WHEN s_nationkey = 5 THEN 'nowhere' WHEN s_nationkey IN (3, 4) THEN 'TWIN' ELSE n_name END) AS f FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, CASE WHEN c = 1 THEN id END AS n_nationkey, CASE WHEN c IS NULL THEN 'absent' WHEN c > 1 THEN 'ambiguous' END AS reason FROM s LEFT JOIN n ON s.f = n.f""")
def name_match_quarantine(spark, d):
    nation = table(spark, d, "nation")
    twin = F.col("n_nationkey").isin(3, 4)
    dim = nation.withColumn("zone", F.when(twin, "twin").otherwise(F.col("n_name")))
    s = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    named = s.select("s_suppkey", F.when(F.col("s_nationkey") == 5, "nowhere").when(twin, " TWIN ").otherwise(F.col("n_name")).alias("name"))
    return enrich.match_by_name(named, dim, "name", "zone", "n_nationkey").select("s_suppkey", "n_nationkey", "reason")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'MA' ELSE CAST(l_partkey AS VARCHAR) END AS code, CASE WHEN l_linenumber = 1 THEN 'country' ELSE p_brand END AS zone_name
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND l_linenumber <> 1 WHERE l_linenumber = 1 OR p_brand IS NOT NULL""")
def dict_enrich_root(spark, d):
    """National rows find the synthetic root zone."""
    zones = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("code"), F.col("p_brand").alias("zone_name"))
    root = spark.createDataFrame([("MA", "country")], "code string, zone_name string")
    facts = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 1, "MA").otherwise(F.col("l_partkey").cast("string")).alias("code"))
    found, _ = enrich.enrich_with_root(facts, zones, root, "code")
    return found.select("l_orderkey", "l_linenumber", "code", "zone_name")


#: A customer's point and a nation's polygon, both from keys: an L-shaped area on a five by five board.
def _points(c):
    return c.select("c_custkey", ((F.col("c_custkey") * 37 % 1000) / 20.0 - 0.013).alias("lon"), ((F.col("c_custkey") * 91 % 1000) / 20.0 - 0.007).alias("lat"))


def _polygons(n):
    x, y = (F.col("n_nationkey") % 5 * 10).cast("double"), (F.floor(F.col("n_nationkey") / 5) * 10).cast("double")
    corner = lambda a, b: F.struct((x + a).alias("lon"), (y + b).alias("lat"))
    ring = F.array(corner(0, 0), corner(9, 0), corner(9, 4), corner(4, 4), corner(4, 9), corner(0, 9), corner(0, 0))
    return n.select("n_nationkey", F.array(F.array(ring)).alias("geom"))


_XY = "CAST(c_custkey * 37 % 1000 AS DOUBLE) / 20.0 - 0.013 AS lon, CAST(c_custkey * 91 % 1000 AS DOUBLE) / 20.0 - 0.007 AS lat"


@query(f"""WITH p AS (SELECT c_custkey, {_XY} FROM customer), n AS (SELECT n_nationkey, CAST(n_nationkey % 5 * 10 AS DOUBLE) AS x, CAST(n_nationkey // 5 * 10 AS DOUBLE) AS y FROM nation)
SELECT c_custkey, n_nationkey FROM p JOIN n ON (lon - x BETWEEN 0 AND 9 AND lat - y BETWEEN 0 AND 4) OR (lon - x BETWEEN 0 AND 4 AND lat - y BETWEEN 0 AND 9)""")
def point_in_polygon(spark, d):
    found = topology.points_in_polygons(_points(table(spark, d, "customer")), _polygons(table(spark, d, "nation")), cell=5.0)
    return found.select("c_custkey", "n_nationkey")


@query(f"""WITH p AS (SELECT c_custkey, {_XY} FROM customer), s AS (SELECT s_suppkey, CAST(s_suppkey * 53 % 1000 AS DOUBLE) / 20.0 AS c_lon, CAST(s_suppkey * 29 % 1000 AS DOUBLE) / 20.0 AS c_lat FROM supplier)
SELECT c_custkey, s_suppkey FROM p JOIN s ON 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(c_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(c_lat)) * pow(sin(radians(c_lon - lon) / 2), 2)))) <= 50""")
def radius_search(spark, d):
    centers = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") * 53 % 1000 / 20.0).alias("c_lon"), (F.col("s_suppkey") * 29 % 1000 / 20.0).alias("c_lat"))
    return spatial.within_radius(_points(table(spark, d, "customer")), centers, 50.0).select("c_custkey", "s_suppkey")


@query("SELECT n_nationkey, CAST(n_nationkey % 3 AS INT) AS largest FROM nation")
def largest_part(spark, d):
    """Three squares a nation, the one of its remainder widest."""
    def square(at: int):
        side = F.when(F.col("n_nationkey") % 3 == at, 2.0).otherwise(1.0)
        corner = lambda a, b: F.struct((a * side + 10 * at).alias("lon"), (b * side).alias("lat"))
        one, none = F.lit(1.0), F.lit(0.0)
        return F.array(F.array(corner(none, none), corner(one, none), corner(one, one), corner(none, one), corner(none, none)))

    n = table(spark, d, "nation").withColumn("geom", F.array(*(square(k) for k in range(3))))
    part = geo.largest_part(F.col("geom"))
    return n.select("n_nationkey", (F.get(F.get(part, F.lit(0)), F.lit(0))["lon"] / 10).cast("int").alias("largest"))


@query("""SELECT c_custkey, 'MA' AS country, 'MA-' || c_nationkey AS region, CASE WHEN c_custkey % 3 > 0 THEN 'MA-' || c_nationkey || '-' || c_custkey END AS province,
CASE c_custkey % 3 WHEN 0 THEN 'region' WHEN 1 THEN 'province' ELSE 'commune' END AS level FROM customer""")
def geo_code_parts(spark, d):
    k = F.col("c_custkey") % 3
    base = F.concat(F.lit("MA-"), F.col("c_nationkey").cast("string"))
    own = F.col("c_custkey").cast("string")
    code = F.when(k == 0, base).when(k == 1, F.concat_ws("-", base, own)).otherwise(F.concat_ws("-", base, own, F.lit("7")))
    parts = text.code_parts(code)
    return table(spark, d, "customer").select("c_custkey", *(parts[x].alias(x) for x in ("country", "region", "province", "level")))


@query("""SELECT c_custkey, CAST(round(x / 20037508.34 * 180, 6) AS DOUBLE) AS lon, CAST(round(degrees(2 * atan(exp(y / 20037508.34 * pi())) - pi() / 2), 6) AS DOUBLE) AS lat
FROM (SELECT c_custkey, CAST(c_custkey * 977 % 20000000 AS DOUBLE) AS x, CAST(c_custkey * 1361 % 15000000 AS DOUBLE) AS y FROM customer)""")
def mercator(spark, d):
    c = table(spark, d, "customer").withColumn("x", (F.col("c_custkey") * 977 % 20000000).cast("double")).withColumn("y", (F.col("c_custkey") * 1361 % 15000000).cast("double"))
    return c.select("c_custkey", geo.mercator_lon(F.col("x")).alias("lon"), geo.mercator_lat(F.col("y")).alias("lat"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 91.0 ELSE CAST(c_nationkey AS DOUBLE) END AS lat, c_custkey % 4 <> 0 AS has_point, CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE -c_custkey END AS chosen FROM customer""")
def node_or_center(spark, d):
    """Coordinates of nodes are their own, others have a centre; a point out of range is none."""
    c = table(spark, d, "customer")
    lat = F.when(F.col("c_custkey") % 4 == 0, F.lit("91,0")).otherwise(F.col("c_nationkey").cast("string"))
    kind = F.when(F.col("c_custkey") % 2 == 0, "node").otherwise("way")
    value = casts.to_double_fr(lat)
    return c.select("c_custkey", value.alias("lat"), geo.point(F.lit(1.0), value).isNotNull().alias("has_point"), geo.own_or_center(kind, F.col("c_custkey"), -F.col("c_custkey")).alias("chosen"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 < 3 THEN CAST(s_suppkey % 5 AS INT) + 1 END AS n_parts, CASE WHEN s_suppkey % 5 < 3 THEN CAST(s_nationkey AS DOUBLE) END AS first_lon FROM supplier")
def polygon_from_geojson(spark, d):
    """One, two and three parts, a point, and text that doesn't parse."""
    k, x = F.col("s_suppkey") % 5, F.col("s_nationkey").cast("string")
    ring = F.concat(F.lit("[[["), x, F.lit(",0],[90,0],[90,9],["), x, F.lit(",0]]]"))
    many = lambda n: F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), F.array_join(F.array_repeat(ring, n), ","), F.lit("]}"))
    j = F.when(k == 0, F.concat(F.lit('{"type":"Polygon","coordinates":'), ring, F.lit("}"))).when(k == 1, many(2)).when(k == 2, many(3)).when(k == 3, '{"type":"Point","coordinates":[1,2]}').otherwise("{broken")
    g = geo.multipolygon(j)
    return table(spark, d, "supplier").select("s_suppkey", F.when(g.isNotNull(), F.size(g)).alias("n_parts"), F.get(F.get(F.get(g, F.lit(0)), F.lit(0)), F.lit(0))["lon"].alias("first_lon"))


def _rings(s):
    k = F.col("s_suppkey") % 5
    p = lambda a, b: F.struct(F.lit(float(a)).alias("lon"), F.lit(float(b)).alias("lat"))
    good = F.array(p(0, 0), p(4, 0), p(4, 4), p(0, 4), p(0, 0))
    ring = F.when(k == 0, good).when(k == 1, F.array(p(0, 0), p(4, 0), p(4, 4), p(0, 4))).when(k == 2, F.array(p(0, 0), p(4, 4), p(4, 0), p(0, 5), p(0, 0))).when(k == 3, F.array(p(0, 0), p(0, 0), p(4, 0), p(4, 4), p(0, 0))).otherwise(F.array(p(0, 0), p(200, 0), p(4, 4), p(0, 0)))
    return s.select("s_suppkey", F.array(F.array(ring)).alias("geom"))


def _drawn(c):
    """Rings of five corners on a board of 12 by 12, drawn from the customer's key; some aren't closed, some leave the globe."""
    k = F.col("c_custkey")
    corner = lambda i: F.struct((k * (7 + 6 * i) % 13 + F.when((k % 37 == 0) & F.lit(i == 2), 175).otherwise(0)).cast("double").alias("lon"), (F.floor(k / (3 + i)) * (5 + 2 * i) % 12).cast("double").alias("lat"))
    corners = F.array(*(corner(i) for i in range(5)))
    return c.select("c_custkey", F.array(F.array(F.when(k % 23 == 0, corners).otherwise(F.concat(corners, F.slice(corners, 1, 1))))).alias("geom"))


#: Every two edges of a ring, compared by their sides.
_DRAWN_SQL = """WITH k AS (SELECT c_custkey, unnest(range(CASE WHEN c_custkey % 23 = 0 THEN 5 ELSE 6 END)) AS pos FROM customer),
p AS (SELECT c_custkey, pos, CAST(c_custkey * (7 + 6 * (pos % 5)) % 13 + CASE WHEN c_custkey % 37 = 0 AND pos % 5 = 2 THEN 175 ELSE 0 END AS DOUBLE) AS x, CAST(c_custkey // (3 + pos % 5) * (5 + 2 * (pos % 5)) % 12 AS DOUBLE) AS y FROM k),
d AS (SELECT * FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM p WINDOW w AS (PARTITION BY c_custkey ORDER BY pos)) WHERE px IS NULL OR px <> x OR py <> y),
e AS (SELECT * FROM (SELECT c_custkey, row_number() OVER w - 1 AS n, count(*) OVER (PARTITION BY c_custkey) - 2 AS last, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS bz FROM d WINDOW w AS (PARTITION BY c_custkey ORDER BY pos)) WHERE bx IS NOT NULL),
s AS (SELECT e.c_custkey, f.n - e.n = 1 OR (e.n = 0 AND f.n = e.last) AS beside,
  sign((f.bx-f.ax)*(e.ay-f.ay)-(f.bz-f.ay)*(e.ax-f.ax)) AS d1, sign((f.bx-f.ax)*(e.bz-f.ay)-(f.bz-f.ay)*(e.bx-f.ax)) AS d2, sign((e.bx-e.ax)*(f.ay-e.ay)-(e.bz-e.ay)*(f.ax-e.ax)) AS d3, sign((e.bx-e.ax)*(f.bz-e.ay)-(e.bz-e.ay)*(f.bx-e.ax)) AS d4,
  least(greatest(e.ax,e.bx),greatest(f.ax,f.bx)) - greatest(least(e.ax,e.bx),least(f.ax,f.bx)) AS sx, least(greatest(e.ay,e.bz),greatest(f.ay,f.bz)) - greatest(least(e.ay,e.bz),least(f.ay,f.bz)) AS sy,
  e.ax BETWEEN least(f.ax,f.bx) AND greatest(f.ax,f.bx) AND e.ay BETWEEN least(f.ay,f.bz) AND greatest(f.ay,f.bz) AS w1, e.bx BETWEEN least(f.ax,f.bx) AND greatest(f.ax,f.bx) AND e.bz BETWEEN least(f.ay,f.bz) AND greatest(f.ay,f.bz) AS w2,
  f.ax BETWEEN least(e.ax,e.bx) AND greatest(e.ax,e.bx) AND f.ay BETWEEN least(e.ay,e.bz) AND greatest(e.ay,e.bz) AS w3, f.bx BETWEEN least(e.ax,e.bx) AND greatest(e.ax,e.bx) AND f.bz BETWEEN least(e.ay,e.bz) AND greatest(e.ay,e.bz) AS w4
  FROM e JOIN e f ON e.c_custkey = f.c_custkey AND e.n < f.n),
m AS (SELECT c_custkey, min(CASE WHEN d1 * d2 < 0 AND d3 * d4 < 0 THEN 1 WHEN d1 = 0 AND d2 = 0 AND d3 = 0 AND d4 = 0 AND sx >= 0 AND sy >= 0 AND sx + sy > 0 THEN 2 WHEN NOT beside AND ((d1 = 0 AND w1) OR (d2 = 0 AND w2) OR (d3 = 0 AND w3) OR (d4 = 0 AND w4)) THEN 3 END) AS worst FROM s GROUP BY c_custkey),
o AS (SELECT c_custkey, bool_or(x > 180) AS out, arg_min(x, pos) <> arg_max(x, pos) OR arg_min(y, pos) <> arg_max(y, pos) AS open FROM p GROUP BY c_custkey),
a AS (SELECT c_custkey, sum(ax * bz - bx * ay) AS area FROM e GROUP BY c_custkey),
v AS (SELECT c_custkey, CASE WHEN out THEN 'out_of_range' WHEN open THEN 'open_ring' WHEN coalesce(area, 0) = 0 THEN 'no_area' WHEN worst = 1 THEN 'self_crossing' WHEN worst = 2 THEN 'overlapping_edges' WHEN worst = 3 THEN 'self_touching' END AS problem FROM o LEFT JOIN a USING (c_custkey) LEFT JOIN m USING (c_custkey))
"""


@query(_DRAWN_SQL + "SELECT c_custkey, problem FROM v")
def polygon_checks(spark, d):
    return topology.geometry_problems(_drawn(table(spark, d, "customer")), ["c_custkey"])


@query("SELECT s_suppkey, CAST(CASE s_suppkey % 5 WHEN 3 THEN 4 WHEN 4 THEN 4 ELSE 5 END AS INT) AS n_points FROM supplier")
def polygon_cleanup(spark, d):
    g = geo.cleaned(F.col("geom"))
    return _rings(table(spark, d, "supplier")).select("s_suppkey", F.size(F.get(F.get(g, F.lit(0)), F.lit(0))).alias("n_points"))


@query(_DRAWN_SQL + "SELECT 'areas' AS table_name, 'geometry valid' AS check_name, CASE WHEN count(problem) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(problem) AS n_failing, count(*) AS n_total FROM v")
def geometry_quality(spark, d):
    problems = topology.geometry_problems(_drawn(table(spark, d, "customer")), ["c_custkey"])
    return quality.validity(problems, "areas", "geometry valid", F.col("problem").isNull())


@query("""WITH c AS (SELECT c_custkey, c_custkey % 20 AS a, c_custkey // 20 % 20 AS b, c_nationkey FROM customer)
SELECT c_custkey, CAST(round(30 + a / 20 + b / 400 + 3 / 8000 + 1 / 16000, 9) AS DOUBLE) AS lat, CAST(round(-8 + b / 20 + a / 400 + 4 / 8000 + 1 / 16000, 9) AS DOUBLE) AS lon FROM c""")
def short_code_geocode(spark, d):
    """Codes of points in one degree cell, decoded next to a reference inside it."""
    c = table(spark, d, "customer")
    digit = lambda k: F.substring(F.lit(geo.GRID_DIGITS), (k + 1).cast("int"), F.lit(1))
    a, b = F.col("c_custkey") % 20, F.floor(F.col("c_custkey") / 20) % 20
    code = F.concat(digit(a), digit(b), digit(b), digit(a), F.lit("+"), F.lit(geo.GRID_DIGITS[3] + geo.GRID_DIGITS[4]))
    zones = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(30.5).alias("ref_lat"), F.lit(-7.5).alias("ref_lon"))
    found = spatial.geocode_short_codes(c.select("c_custkey", "c_nationkey", code.alias("code")), zones, "c_nationkey")
    return found.select("c_custkey", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@query("""WITH s AS (SELECT s_suppkey // 256 AS batch, * FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT batch, 1 AS level, r_name AS name, CAST(r_regionkey AS BIGINT) AS code, NULL AS name_1, NULL AS name_2 FROM s GROUP BY batch, r_name, r_regionkey
UNION ALL SELECT batch, 2, n_name, CAST(n_nationkey AS BIGINT), r_name, NULL FROM s WHERE n_nationkey % 6 <> 0 GROUP BY batch, n_name, n_nationkey, r_name
UNION ALL SELECT batch, 3, s_name, s_suppkey, r_name, n_name FROM s""")
def tree_flatten(spark, d):
    """Batches of 256 suppliers nested by region and nation and flattened; each sixth nation lacks a centroid. No tree grows with the table."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumn("batch", F.floor(F.col("s_suppkey") / 256))
    leaves = s.groupBy("batch", "r_regionkey", "r_name", "n_nationkey", "n_name").agg(F.collect_list(F.struct(F.col("s_name").alias("name"), F.col("s_suppkey").alias("code"), F.lit(1.0).alias("centroid"))).alias("children"))
    centroid = F.when(F.col("n_nationkey") % 6 != 0, F.lit(1.0))
    nations = leaves.groupBy("batch", "r_regionkey", "r_name").agg(F.collect_list(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").cast("bigint").alias("code"), centroid.alias("centroid"), "children")).alias("children"))
    root = F.struct(F.col("r_name").alias("name"), F.col("r_regionkey").cast("bigint").alias("code"), F.lit(1.0).alias("centroid"), "children")
    return nested.flatten_tree(nations.select("batch", root.alias("root")), "root", 3, ["name", "code"], "centroid", keep=["batch"])


@query("SELECT p_partkey, CAST(p_partkey % 12 + 1 AS INT) AS depth, CAST(p_size AS VARCHAR) AS value FROM part")
def deep_field(spark, d):
    """A field at a depth that differs by row, from 1 to 12."""
    size, k = F.col("p_size").cast("string"), (F.col("p_partkey") % 12).cast("int")
    j = F.concat(F.repeat(F.lit('{"a":'), k), F.lit('{"iso":'), size, F.lit("}"), F.repeat(F.lit(',"b":[]}'), k))
    return nested.find_field(table(spark, d, "part").select("p_partkey", j.alias("j")), "j", "iso", ["p_partkey"])


@query("SELECT CAST(s_nationkey AS INT) AS batch, s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'node' ELSE 'way' END AS kind, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS DOUBLE) ELSE CAST(s_nationkey AS DOUBLE) END AS lat, CASE WHEN s_suppkey % 3 = 0 THEN 'shop' END AS category FROM supplier")
def response_elements(spark, d):
    s = table(spark, d, "supplier")
    even, own = F.col("s_suppkey") % 2 == 0, F.col("s_suppkey").cast("double")
    element = F.struct(F.when(even, "node").otherwise("way").alias("kind"), F.col("s_suppkey").alias("id"), F.when(even, own).alias("lat"), F.when(~even, F.struct(F.col("s_nationkey").cast("double").alias("lat"))).alias("center"), F.when(F.col("s_suppkey") % 3 == 0, F.create_map(F.lit("shop"), F.lit("kiosk"))).otherwise(F.create_map(F.lit("name"), F.lit("x"))).alias("tags"))
    answers = s.groupBy(F.col("s_nationkey").alias("batch"), (F.col("s_suppkey") / 64).cast("bigint")).agg(F.to_json(F.struct(F.collect_list(element).alias("elements"))).alias("answer"))
    e = nested.explode_elements(answers, "answer", "struct<kind:string,id:bigint,lat:double,center:struct<lat:double>,tags:map<string,string>>", ["batch"])
    return e.select("batch", "id", "kind", geo.own_or_center(F.col("kind"), F.col("lat"), F.col("center.lat")).alias("lat"), text.pick_category(F.col("tags"))["key"].alias("category"))


@query("SELECT p_partkey, p_brand AS h1, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_type || ' Montant' END AS h2, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN p_type || ' %' ELSE p_type || ' ' || p_size END AS h3 FROM part")
def header_merge(spark, d):
    """Brands and types over sub-labels; a third of the second rows names no amount, and isn't one of sub-labels."""
    m = F.col("p_partkey") % 3
    second = F.array(F.lit(""), F.when(m == 0, "x").otherwise(" Montant "), F.when(m == 1, "%").otherwise(F.col("p_size").cast("string")))
    h = nested.merged_header(F.array(F.concat(F.lit(" "), F.col("p_brand")), F.col("p_type"), F.lit("")), second)
    return table(spark, d, "part").select("p_partkey", *(F.get(h, F.lit(k)).alias(f"h{k + 1}") for k in range(3)))


@query("SELECT o_custkey, o_orderkey // 4096 AS batch, CAST(row_number() OVER (PARTITION BY o_custkey, o_orderkey // 4096 ORDER BY o_orderkey) AS INT) AS line, CAST(o_orderkey AS VARCHAR) AS a, o_orderstatus AS b FROM orders")
def cell_expand(spark, d):
    """A customer's orders, in batches of 4,096 keys, as lines of two cells, and back."""
    o = table(spark, d, "orders").groupBy("o_custkey", F.floor(F.col("o_orderkey") / 4096).alias("batch")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("os"))
    joined = lambda f: F.array_join(F.transform("os", lambda x: x[f].cast("string")), "\n")
    rows = o.select("o_custkey", "batch", F.array(joined("o_orderkey"), joined("o_orderstatus")).alias("row"))
    e = nested.expand_cells(rows, "row", ["o_custkey", "batch"])
    return e.select("o_custkey", "batch", "line", F.get("row", F.lit(0)).alias("a"), F.get("row", F.lit(1)).alias("b"))


def _grids(s):
    """Batches of 64 supplier keys of a nation as grids with a two-row header, a blank row and a total."""
    row = lambda *cells: F.array(*(F.lit(c) for c in cells))
    data = F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name", text2("s_acctbal").alias("m")))), lambda x: F.array(x["s_suppkey"].cast("string"), x["s_name"], x["m"]))
    g = s.groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 64).alias("batch")).agg(data.alias("rows"))
    return g.select("s_nationkey", "batch", F.concat(F.array(row("Code", "Nom", "Depots"), row("", "", "Montant")), F.col("rows"), F.array(row("", "", ""), row("Total général", "", "9"))).alias("grid"))


@query("SELECT s_nationkey, s_suppkey // 64 AS batch, CAST(row_number() OVER (PARTITION BY s_nationkey, s_suppkey // 64 ORDER BY s_suppkey) AS INT) AS row_number, CAST(s_suppkey AS VARCHAR) AS code, CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS VARCHAR) AS amount, '12-2025' AS periode FROM supplier")
def grid_records(spark, d):
    r = nested.table_rows(_grids(table(spark, d, "supplier")), "grid", ["s_nationkey", "batch"])
    r = r.withColumn("record", nested.with_period(F.col("record"), text.period_from_title(F.lit("Repartition 12-2025"))))
    return r.select("s_nationkey", "batch", "row_number", *(F.try_element_at("record", F.lit(k)).alias(n) for k, n in (("Code", "code"), ("Depots Montant", "amount"), ("periode", "periode"))))


@query("SELECT CAST(s_nationkey AS INT) AS s_nationkey, CAST(count(*) AS BIGINT) AS n_rows FROM supplier GROUP BY s_nationkey")
def total_rows_dropped(spark, d):
    rows = _grids(table(spark, d, "supplier")).select("s_nationkey", F.explode("grid").alias("r"))
    kept = rows.where(nested.data_row(F.get("r", F.lit(0))) & (F.get("r", F.lit(0)) != "Code"))
    return kept.groupBy("s_nationkey").agg(F.count("*").alias("n_rows"))


@query("SELECT p_brand, p_partkey // 4096 AS sheet, CAST(row_number() OVER (PARTITION BY p_brand, p_partkey // 4096 ORDER BY p_partkey) AS INT) AS row_number, CAST(p_partkey AS VARCHAR) AS k, CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS size FROM part WHERE p_partkey % 5 <> 0")
def sheet_records(spark, d):
    """A brand's sheets of 4,096 part keys: each fifth row is all null, small sizes are null cells."""
    full = F.col("p_partkey") % 5 != 0
    record = F.map_from_arrays(F.array(F.lit("k"), F.lit("size")), F.array(F.when(full, F.col("p_partkey").cast("string")), F.when(full & (F.col("p_size") > 25), F.col("p_size").cast("string"))))
    r = nested.sheet_records(table(spark, d, "part").withColumns({"record": record, "sheet": F.floor(F.col("p_partkey") / 4096)}), "record", ["p_brand", "sheet"], "p_partkey")
    return r.select("p_brand", "sheet", "row_number", F.try_element_at("record", F.lit("k")).alias("k"), F.try_element_at("record", F.lit("size")).alias("size"))


@query("SELECT o_orderkey // 64 AS page_id, CAST(o_orderkey AS VARCHAR) AS code, o_orderstatus AS status, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS amount FROM orders")
def html_tables(spark, d):
    """Batches of 64 order keys rendered as HTML beside another table, cells taken out, the marked table chosen, records built."""
    row = F.concat(F.lit("<tr><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td><b>"), F.col("o_orderstatus"), F.lit("</b></td><td>\n"), text2("o_totalprice"), F.lit("</tr>"))
    # dealt to a fixed number of tasks: parsing takes long for few bytes, and partitions are joined by their bytes
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = table(spark, d, "orders").withColumn("page_id", F.floor(F.col("o_orderkey") / 64)).repartition(tasks, "page_id")
    g = dealt.groupBy("page_id").agg(F.array_join(F.collect_list(row), "").alias("rows"))
    html = F.concat(F.lit("<table><tr><td>menu</td></tr></table><table><tr><th>Códe</th><th>Status</th><th>Amount</th></tr>"), F.col("rows"), F.lit("</table>"))
    grids = pages.extract_html_tables(g.select("page_id", html.alias("html")))
    chosen = grids.groupBy("page_id").agg(nested.choose_table(F.transform(F.array_sort(F.collect_list(F.struct("table_no", "grid"))), lambda t: t["grid"]), " CODE ").alias("grid"))
    r = nested.grid_records(chosen, "grid", ["page_id"])
    return r.select("page_id", *(F.try_element_at("record", F.lit(k)).alias(n) for k, n in (("Códe", "code"), ("Status", "status"), ("Amount", "amount"))))


@query("""WITH s AS (SELECT s_suppkey AS k, CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS VARCHAR) AS b FROM supplier)
SELECT k, CAST(1 AS INT) AS row_number, 'A' || k AS code, b AS amount, '1' AS share FROM s UNION ALL SELECT k, 2, 'B' || k, '7', '2' FROM s UNION ALL SELECT k, 3, 'Ensemble', b, '3' FROM s WHERE k % 2 = 1""")
def table_chain(spark, d):
    """Tables whose one data row holds lines, with merged headers and a summary row that is kept unless it is a total."""
    k, b = F.col("s_suppkey").cast("string"), text2("s_acctbal")
    cells = lambda *x: F.array(*(c if isinstance(c, Column) else F.lit(c) for c in x))
    grid = F.array(cells("Code", "Dépôts", ""), cells("", "Montant", "%"), cells(F.concat(F.lit("A"), k, F.lit("\nB"), k), F.concat(b, F.lit("\n7")), "1\n2"), cells(F.when(F.col("s_suppkey") % 2 == 1, "Ensemble").otherwise("TOTAL"), b, "3"))
    rows = nested.table_rows(table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), grid.alias("grid")), "grid", ["k"])
    return rows.select("k", "row_number", *(F.try_element_at("record", F.lit(h)).alias(n) for h, n in (("Code", "code"), ("Dépôts Montant", "amount"), ("Dépôts %", "share"))))


_LINKS = r"""WITH a AS (SELECT page_id, url AS base, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href,
unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2)) AS title, unnest(range(CAST(len(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS BIGINT))) AS pos FROM pages),
u AS (SELECT page_id, CAST(pos AS INT) AS pos, CASE WHEN starts_with(trim(href), 'http') THEN trim(href) ELSE regexp_extract(base, '^([a-z]+://[^/?#]+)', 1) || trim(href) END AS url, trim(regexp_replace(regexp_replace(title, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM a)
"""


@query(_LINKS + "SELECT page_id, min(pos) AS pos, url, arg_min(title, pos) AS title FROM u GROUP BY page_id, url")
def page_links(spark, d):
    return pages.extract_links(table(spark, d, "pages"))


@query(_LINKS + """SELECT page_id, min(pos) AS pos, url, arg_min(title, pos) AS title FROM u
WHERE (ends_with(lower(url), 'en') OR ends_with(lower(url), 'tion.') OR ends_with(lower(url), 'er')) AND (contains(lower(title || ' ' || url), '/th') OR contains(lower(title || ' ' || url), '/re') OR contains(lower(title || ' ' || url), 'ch')) GROUP BY page_id, url""")
def page_links_chosen(spark, d):
    """Links by keyword of title or address and by ending."""
    return pages.extract_links(table(spark, d, "pages"), keywords=["/TH", "/re", "ch"], suffixes=["en", "tion.", "er"])


@query("""SELECT doc_id, '2024' AS year, CASE WHEN doc_id % 3 = 0 THEN CAST(n_chars AS VARCHAR) END AS density, CASE WHEN doc_id % 3 = 1 THEN CAST(doc_id AS VARCHAR) END AS agencies, CASE WHEN doc_id % 3 = 1 THEN '1,6' END AS per_10000 FROM documents WHERE doc_id % 3 < 2""")
def text_indicators(spark, d):
    """Each document with a sentence appended; a third has none."""
    k = F.col("doc_id") % 3
    added = F.when(k == 0, F.concat(F.lit(" La densité bancaire du pays ressort à "), F.col("n_chars").cast("string"))).when(k == 1, F.concat(F.lit(" Le nombre d'agences bancaires s'est accru pour ressortir à "), F.col("doc_id").cast("string"), F.lit("; Le nombre d'agences pour 10 000 habitants s'est établi à 1,6"))).otherwise("")
    docs = table(spark, d, "documents").select("doc_id", F.concat("text", added).alias("text"), F.lit("Rapport annuel 2024").alias("title"))
    # Patterns of the report's sentences.
    patterns = {"density": [r"(?i)densit[ée]\s+bancaire[^.]{0,120}?ressort\s*à\s*([0-9.,\s]+)"], "agencies": [r"(?i)nombre\s+d.agences\s+bancaires[^.]{0,120}?ressortir\s*à\s*([0-9.,\s]+)"],
                "per_10000": [r"(?i)nombre\s+d.agences\s+pour\s+10\s*[.]?\s*000\s+habitants[^.]{0,60}?établi\s*à\s*([0-9.,]+)"]}
    return pages.text_indicators(docs, "text", "title", patterns, ["doc_id"])


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/a' ELSE 'http://x/b' END AS link FROM pages")
def absolute_links(spark, d):
    href = F.when(F.col("page_id") % 2 == 0, "/a").otherwise("http://x/b")
    return table(spark, d, "pages").select("page_id", text.absolute_url(href, F.col("url")).alias("link"))
