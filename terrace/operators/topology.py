"""Edges on a grid: validity of polygons and point-in-polygon without copies of whole geometries (FN-33, DQ-5, JN-13).

Polygons are taken apart into edges, and each edge is dealt to the grid cells that it passes. Whatever touches shares a
cell, so an equality join on cells finds it, and exact tests of two segments, or of a point and an edge, decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import geo
from terrace.functions.casts import once
from terrace.sources.storage import stored

#: Part of a cell by which edges are widened, so that what meets on the border of two cells meets in both.
SLACK = 1e-7
#: Parts of a cell by which the grid of the index is moved, so that its corners lie on no edge that people draw, slanting ones included.
MOVED_X, MOVED_Y = 0.381966011250105, 0.718281828459045
#: Points of a cell that meet its polygons in one task.
CROWD = 100_000
#: Points of a geometry whose edges are compared in place, every two of them.
FEW = 32

#: Problems in the order in which they are told, the first alone.
PROBLEMS = ("no_geometry", "too_few_points", "out_of_range", "open_ring", "no_area", "self_crossing", "overlapping_edges", "self_touching", "rings_crossing", "rings_touching_twice", "hole_outside", "holes_nested", "parts_overlapping")


def ring_edges(df: DataFrame, keys: list[str], geom: str, more: list[str] | None = None) -> DataFrame:
    """keys, part, ring, at, ax, ay, bx, by, last (number of the ring's last edge) of all edges that have a length."""
    single = lambda ring: F.filter(ring, lambda p, i: (i == 0) | (p != F.get(ring, i - 1)))
    parts = df.select(*keys, *(more or []), F.posexplode(geom).alias("part", "_rings"))
    rings = parts.select(*keys, *(more or []), "part", F.posexplode("_rings").alias("ring", "_ring")).withColumn("_ring", single(F.col("_ring")))
    found = rings.select(*keys, *(more or []), "part", "ring", (F.size("_ring") - 2).alias("last"), F.posexplode(geo.edges(F.col("_ring"))).alias("at", "_e"))
    return found.select(*keys, *(more or []), "part", "ring", "at", F.col("_e.a.lon").alias("ax"), F.col("_e.a.lat").alias("ay"), F.col("_e.b.lon").alias("bx"), F.col("_e.b.lat").alias("by"), "last")


def passed_rows(low: Column, high: Column, height: Column, moved: float = 0.0) -> Column:
    """Rows of cells that a range of y touches."""
    slack = height * SLACK
    return F.sequence(F.floor((low - slack) / height - moved), F.floor((high + slack) / height - moved))


def passed_cells(width: Column, height: Column, moved_x: float = 0.0, moved_y: float = 0.0) -> Column:
    """array<struct(cx, cy)> of the cells that the edge (ax, ay, bx, by) passes: column by column, its stretch in each."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    left, right, low, high = F.least(ax, bx), F.greatest(ax, bx), F.least(ay, by), F.greatest(ay, by)

    def y_at(x: Column) -> Column:
        y = ay + (by - ay) * (F.least(F.greatest(x, left), right) - ax) / (bx - ax)
        return F.least(F.greatest(y, low), high)

    def column(cx: Column) -> Column:
        x0, x1 = (cx + moved_x - SLACK) * width, (cx + 1 + moved_x + SLACK) * width
        rows = F.when(ax == bx, passed_rows(low, high, height, moved_y)).otherwise(passed_rows(F.least(y_at(x0), y_at(x1)), F.greatest(y_at(x0), y_at(x1)), height, moved_y))
        return F.transform(rows, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))

    return F.flatten(F.transform(passed_rows(left, right, width, moved_x), column))


def _side(px: str, py: str, e: str) -> Column:
    """-1, 0 or 1: the side of edge ``e`` that a point is on."""
    c = lambda x: F.col(f"{e}.{x}")
    return F.signum((c("bx") - c("ax")) * (F.col(py) - c("ay")) - (c("by") - c("ay")) * (F.col(px) - c("ax")))


def edge_pairs(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs (e, f) of edges of one geometry that share a cell, once for each such cell; e comes first.

    ``edges`` have width and height, the cells of their geometry.
    """
    celled = edges.withColumn("_c", F.explode(passed_cells(F.col("width"), F.col("height")))).withColumns({"cx": F.col("_c.cx"), "cy": F.col("_c.cy")}).drop("_c", "width", "height")
    e, f = celled.alias("e"), celled.alias("f")
    same = F.lit(True)
    for k in (*keys, "cx", "cy"):
        same = same & (F.col(f"e.{k}") == F.col(f"f.{k}"))
    place = lambda x: F.struct(*(F.col(f"{x}.{c}") for c in ("part", "ring", "at")))
    return e.join(f, same & (place("e") < place("f")))


def pairs_in_place(df: DataFrame, keys: list[str], geom: str) -> DataFrame:
    """Pairs (e, f) of all edges of one geometry of few points, as ``edge_pairs`` gives those that share a cell; nothing is shuffled."""
    single = lambda ring: F.filter(ring, lambda p, i: (i == 0) | (p != F.get(ring, i - 1)))
    names = ("part", "ring", "at", "ax", "ay", "bx", "by", "last")

    def of_ring(ring: Column, part: Column, at: Column) -> Column:
        numbered = lambda s: lambda e, i: F.struct(*(x.alias(n) for n, x in zip(names, (part, at, i, e["a"]["lon"], e["a"]["lat"], e["b"]["lon"], e["b"]["lat"], F.size(s) - 2), strict=True)))
        return once(single(ring), lambda s: F.transform(geo.edges(s), numbered(s)))

    every = F.flatten(F.transform(geom, lambda rings, p: F.flatten(F.transform(rings, lambda ring, r: of_ring(ring, p, r)))))
    first = df.select(*keys, every.alias("_e")).select(*keys, "_e", F.posexplode("_e").alias("_i", "e"))
    return first.select(F.struct(*keys, *(F.col(f"e.{n}").alias(n) for n in names)).alias("e"), F.explode(F.slice("_e", F.col("_i") + 2, F.size("_e"))).alias("f"))


def touches(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """What is wrong with pairs of edges, or where they touch: keys, both places, kind, x and y of a touching point.

    kind: crossing, overlap, or touch; neighbours of one ring only overlap.
    """
    c = F.col
    d1, d2, d3, d4 = _side("e.ax", "e.ay", "f"), _side("e.bx", "e.by", "f"), _side("f.ax", "f.ay", "e"), _side("f.bx", "f.by", "e")
    one_ring = (c("e.part") == c("f.part")) & (c("e.ring") == c("f.ring"))
    beside = one_ring & ((c("f.at") - c("e.at") == 1) | ((c("e.at") == 0) & (c("f.at") == c("e.last"))))

    def shared(axis: str) -> Column:
        low = F.greatest(F.least(f"e.a{axis}", f"e.b{axis}"), F.least(f"f.a{axis}", f"f.b{axis}"))
        return F.least(F.greatest(f"e.a{axis}", f"e.b{axis}"), F.greatest(f"f.a{axis}", f"f.b{axis}")) - low

    def on(own: str, end: str, e: str, side: Column) -> Column:
        within = [c(f"{own}.{end}{a}").between(F.least(f"{e}.a{a}", f"{e}.b{a}"), F.greatest(f"{e}.a{a}", f"{e}.b{a}")) for a in ("x", "y")]
        return (side == 0) & within[0] & within[1]

    flat = (d1 == 0) & (d2 == 0) & (d3 == 0) & (d4 == 0)
    overlap = flat & (shared("x") >= 0) & (shared("y") >= 0) & (shared("x") + shared("y") > 0)
    kind = F.when((d1 * d2 < 0) & (d3 * d4 < 0), "crossing").when(overlap, "overlap")
    point = F.coalesce(*(F.when(on(own, end, e, side), F.struct(c(f"{own}.{end}x").alias("x"), c(f"{own}.{end}y").alias("y"))) for own, end, e, side in (("e", "a", "f", d1), ("e", "b", "f", d2), ("f", "a", "e", d3), ("f", "b", "e", d4))))
    found = pairs.withColumn("_p", point).withColumn("kind", kind)
    found = found.withColumn("kind", F.coalesce("kind", F.when(c("_p").isNotNull() & ~beside, "touch"))).where("kind IS NOT NULL")
    of = lambda x: [c(f"{x}.{n}").alias(f"{x}_{n}") for n in ("part", "ring", "at")]
    return found.select(*(c(f"e.{k}").alias(k) for k in keys), *of("e"), *of("f"), "kind", c("_p.x").alias("x"), c("_p.y").alias("y"))


def _holders(points: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """``points`` (keys, of_part, of_ring, x, y) with the rings (part, ring) of their geometry that hold them.

    Edges are dealt to rows of cells, and a point meets those of its own row: an odd number to its right means inside.
    """
    rows = edges.withColumn("row", F.explode(passed_rows(F.least("ay", "by"), F.greatest("ay", "by"), F.col("height")))).select(*keys, "row", "part", "ring", "ax", "ay", "bx", "by")
    heights = edges.select(*keys, "height").distinct()
    at = points.join(heights, keys).withColumn("row", F.floor(F.col("y") / F.col("height"))).drop("height")
    spans = (F.col("ay") > F.col("y")) != (F.col("by") > F.col("y"))
    right = F.col("x") < (F.col("bx") - F.col("ax")) * (F.col("y") - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax")
    met = at.join(rows, [*keys, "row"]).where(spans & right)
    return met.groupBy(*keys, "of_part", "of_ring", "x", "y", "part", "ring").agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n")


def geometry_problems(df: DataFrame, keys: list[str], geom: str = "geom") -> DataFrame:
    """keys and problem, one of PROBLEMS or null, of each geometry; ``keys`` name a row.

    A polygon is valid if its rings are closed, simple, touch each other in a point at most, holes lie inside
    their shell and in no other hole, and parts share points alone. Not seen: a chain of three or more rings that touch
    one another in a closed round and so split the inside.
    """
    n = F.aggregate(F.flatten(geom), F.lit(0), lambda s, r: s + F.size(r))
    side = lambda a: F.aggregate(F.flatten(geom), F.lit(0.0), lambda s, r: s + F.aggregate(geo.edges(r), F.lit(0.0), lambda t, e: t + F.abs(e["b"][a] - e["a"][a])))
    # cells twice as wide and high as an edge is in the mean: edges pass few cells, and cells hold few edges
    size = lambda a: F.greatest(2 * side(a) / n, side("lon") / n / 100, side("lat") / n / 100)
    # dealt out, since a small file may hold many polygons
    simple = stored(df.repartition(*keys).select(*keys, geom, geo.simple_problem(F.col(geom)).alias("problem")), "simple")
    sound = simple.where("problem IS NULL").withColumns({"width": size("lon"), "height": size("lat")})
    # one ring of few points needs no edges beside its row
    sound = sound.withColumns({"few": n <= FEW, "several": F.size(F.flatten(geom)) > 1})
    edges = stored(ring_edges(sound.where("several OR NOT few"), keys, geom, ["width", "height", "few", "several"]), "edges")
    by_cells = touches(edge_pairs(edges.where("NOT few").drop("few", "several"), keys), keys)
    found = stored(by_cells.unionByName(touches(pairs_in_place(sound.where("few"), keys, geom), keys)), "touches")
    edges = edges.where("several").drop("few", "several")

    one_part, one_ring = F.col("e_part") == F.col("f_part"), F.col("e_ring") == F.col("f_ring")
    name = F.when(F.col("kind") == "overlap", "overlapping_edges").when(one_part & one_ring, F.when(F.col("kind") == "crossing", "self_crossing").otherwise("self_touching"))
    name = F.coalesce(name, F.when(F.col("kind") == "crossing", F.when(one_part, "rings_crossing").otherwise("parts_overlapping")))
    told = found.select(*keys, name.alias("problem")).where("problem IS NOT NULL")
    twice = found.where((F.col("kind") == "touch") & one_part & ~one_ring).groupBy(*keys, "e_part", "e_ring", "f_ring").agg(F.count_distinct("x", "y").alias("n")).where("n > 1")

    # a corner of each ring that touches no other ring, or the middle of an edge
    touched = found.where(F.col("kind") == "touch").select(*keys, F.explode(F.array(F.struct(F.col("e_part").alias("part"), F.col("e_ring").alias("ring")), F.struct(F.col("f_part").alias("part"), F.col("f_ring").alias("ring")))).alias("r"), "x", "y")
    touched = touched.select(*keys, "r.part", "r.ring", F.col("x").alias("ax"), F.col("y").alias("ay")).distinct()
    free = edges.join(touched, [*keys, "part", "ring", "ax", "ay"], "left_anti").groupBy(*keys, "part", "ring").agg(F.min(F.struct("at", "ax", "ay")).alias("m"))
    middle = edges.where("at = 0").select(*keys, "part", "ring", ((F.col("ax") + F.col("bx")) / 2).alias("mx"), ((F.col("ay") + F.col("by")) / 2).alias("my"))
    corner = middle.join(free, [*keys, "part", "ring"], "left").select(*keys, F.col("part").alias("of_part"), F.col("ring").alias("of_ring"), F.coalesce("m.ax", "mx").alias("x"), F.coalesce("m.ay", "my").alias("y"))
    held = stored(_holders(corner, edges, keys), "holders")
    holes = edges.where("ring > 0").select(*keys, F.col("part").alias("of_part"), F.col("ring").alias("of_ring")).distinct()
    own_shell = held.where("part = of_part AND ring = 0").select(*keys, "of_part", "of_ring")
    outside = holes.join(own_shell, [*keys, "of_part", "of_ring"], "left_anti")
    nested = held.where("part = of_part AND of_ring > 0 AND ring > 0 AND ring <> of_ring")
    # parts: a ring inside another part, or a stretch of an edge beside a touching point
    flat = F.abs(F.col("bx") - F.col("ax")) > F.abs(F.col("by") - F.col("ay"))
    t = F.when(flat, (F.col("x") - F.col("ax")) / (F.col("bx") - F.col("ax"))).otherwise((F.col("y") - F.col("ay")) / (F.col("by") - F.col("ay"))) + 0.0  # of zeros none is negative
    across = found.where((F.col("kind") == "touch") & ~one_part)
    ends = across.select(*keys, F.explode(F.array(*(F.struct(*(F.col(f"{s}_{c}").alias(c) for c in ("part", "ring", "at"))) for s in ("e", "f")))).alias("r"), "x", "y").select(*keys, "r.*", "x", "y")
    cuts = edges.join(ends, [*keys, "part", "ring", "at"]).groupBy(*keys, "part", "ring", "at", "ax", "ay", "bx", "by").agg(F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.collect_set(t)))).alias("t"))
    stretch = F.explode(F.transform(F.slice("t", 1, F.size("t") - 1), lambda v, i: (v + F.get("t", i + 1)) / 2)).alias("m")
    middles = cuts.select(*keys, F.col("part").alias("of_part"), F.col("ring").alias("of_ring"), "ax", "ay", "bx", "by", stretch)
    middles = middles.select(*keys, "of_part", "of_ring", (F.col("ax") + (F.col("bx") - F.col("ax")) * F.col("m")).alias("x"), (F.col("ay") + (F.col("by") - F.col("ay")) * F.col("m")).alias("y"))
    inside = held.where("of_ring = 0").unionByName(_holders(middles, edges, keys)).where("part <> of_part")
    overlapping = inside.groupBy(*keys, "of_part", "of_ring", "x", "y", "part").agg(F.count("*").alias("n")).where("n % 2 = 1")

    parts = [told, *(x.select(*keys, F.lit(n).alias("problem")) for n, x in (("rings_touching_twice", twice), ("hole_outside", outside), ("holes_nested", nested), ("parts_overlapping", overlapping)))]
    every = parts[0]
    for x in parts[1:]:
        every = every.unionByName(x)
    rank = F.array_position(F.array(*map(F.lit, PROBLEMS)), F.col("problem"))
    first = every.groupBy(*keys).agg(F.min(F.struct(rank.alias("rank"), "problem")).alias("_first"))
    return simple.drop(geom).join(first, keys, "left").select(*keys, F.coalesce("problem", "_first.problem").alias("problem"))


def cell_index(polygons: DataFrame, key: str, cell: float, geom: str = "geom") -> DataFrame:
    """key, cx, cy, parts of every cell that a polygon touches: for each of its parts there, whether the cell's lower left corner is inside, and the edges that pass the cell.

    A cell inside a part has no edges, so the rows together are about as large as the polygons and their cells.
    """
    edges = stored(ring_edges(polygons, [key], geom).select(key, "part", "ax", "ay", "bx", "by"), "edges")
    size = F.lit(float(cell))
    passed = edges.withColumn("_c", F.explode(passed_cells(size, size, MOVED_X, MOVED_Y)))
    passed = passed.groupBy(key, "part", F.col("_c.cx").alias("cx"), F.col("_c.cy").alias("cy")).agg(F.collect_list(F.struct("ax", "ay", "bx", "by")).alias("edges"))
    # where edges pass the lower sides of rows, in order: corners between an odd and an even one are inside
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    lines = F.sequence(F.ceil(low / size - MOVED_Y), F.ceil(high / size - MOVED_Y))
    crossed = edges.withColumn("cy", F.explode(lines)).withColumn("y", (F.col("cy") + MOVED_Y) * size).where((F.col("ay") > F.col("y")) != (F.col("by") > F.col("y")))
    crossed = crossed.select(key, "part", "cy", ((F.col("bx") - F.col("ax")) * (F.col("y") - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax")).alias("x"))
    line = Window.partitionBy(key, "part", "cy").orderBy("x")
    spans = crossed.withColumns({"to": F.lead("x").over(line), "n": F.row_number().over(line)}).where("n % 2 = 1")
    corner = lambda x: F.ceil(F.col(x) / size - MOVED_X)
    inner = spans.where(corner("x") < corner("to")).select(key, "part", F.explode(F.sequence(corner("x"), corner("to") - 1)).alias("cx"), "cy", F.lit(True).alias("corner"))
    whole = passed.join(inner, [key, "part", "cx", "cy"], "full_outer")
    none = F.array().cast("array<struct<ax:double,ay:double,bx:double,by:double>>")
    return whole.groupBy(key, "cx", "cy").agg(F.collect_list(F.struct(F.coalesce("corner", F.lit(False)).alias("corner"), F.coalesce("edges", none).alias("edges"))).alias("parts"))


def _inside(cell: float) -> Column:
    """Whether (lon, lat) is inside one of ``parts``: the corner's side, changed by each edge between it and the point.

    The way goes up from the corner and then right.
    """
    x0, y0 = (F.col("cx") + MOVED_X) * cell, (F.col("cy") + MOVED_Y) * cell
    lon, lat = F.col("lon"), F.col("lat")

    def changes(e: Column) -> Column:
        y = e["ay"] + (e["by"] - e["ay"]) * (x0 - e["ax"]) / F.nullif(e["bx"] - e["ax"], F.lit(0.0))
        up = ((e["ax"] > x0) != (e["bx"] > x0)) & ((y > y0) != (y > lat))
        x = (e["bx"] - e["ax"]) * (lat - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"]
        across = ((e["ay"] > lat) != (e["by"] > lat)) & ((x0 < x) != (lon < x))
        return F.coalesce(up, F.lit(False)) != F.coalesce(across, F.lit(False))

    return F.exists("parts", lambda p: F.aggregate(p["edges"], p["corner"], lambda s, e: s != changes(e)))


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float, geom: str = "geom") -> DataFrame:
    """points (lon, lat, ...) joined with the polygons that hold them, once each.

    Points meet the polygons of their own cell alone; those of a crowded cell are dealt out over several tasks. The
    cell size should be near a polygon's usual width or below; a smaller one makes shorter lists of edges and more cells.
    """
    from_store = stored(polygons.withColumn("_pid", F.monotonically_increasing_id()), "polygons")
    index = cell_index(from_store, "_pid", cell, geom).join(from_store.drop(geom), "_pid").drop("_pid")
    at = points.withColumns({"cx": F.floor(F.col("lon") / cell - MOVED_X), "cy": F.floor(F.col("lat") / cell - MOVED_Y)})
    crowded = at.groupBy("cx", "cy").count().where(F.col("count") > CROWD).select("cx", "cy", F.ceil(F.col("count") / CROWD).cast("int").alias("_tasks"))
    tasks = F.coalesce("_tasks", F.lit(1))
    at = at.join(crowded, ["cx", "cy"], "left").withColumn("_task", F.pmod(F.xxhash64("lon", "lat"), tasks).cast("int")).drop("_tasks")
    dealt = index.join(crowded, ["cx", "cy"], "left").withColumn("_task", F.explode(F.sequence(F.lit(0), tasks - 1))).drop("_tasks")
    return at.join(dealt, ["cx", "cy", "_task"]).where(_inside(cell)).drop("cx", "cy", "_task", "parts")
