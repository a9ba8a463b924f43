"""Validity of polygons and points in polygons, against comparisons of all edges."""

import math
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from terrace.functions import geo
from terrace.operators import topology

GEOM = "array<array<array<struct<lon:double,lat:double>>>>"


def frame(spark, geoms):
    rows = [(k, None if g is None else [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in g]) for k, g in enumerate(geoms)]
    return spark.createDataFrame(rows, f"k int, geom {GEOM}")


def side(p, a, b):
    v = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    return (v > 0) - (v < 0)


def between(p, a, b):
    return all(min(a[k], b[k]) <= p[k] <= max(a[k], b[k]) for k in (0, 1))


def inside(p, ring):
    odd = False
    for a, b in zip(ring, ring[1:]):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            odd = not odd
    return odd


def on_ring(p, ring):
    return any(side(p, a, b) == 0 and between(p, a, b) for a, b in zip(ring, ring[1:]))


def brute(geom):
    """All problems of a polygon whose rings are sound by themselves."""
    edges = [(i, j, k, a, b, len(ring) - 2) for i, part in enumerate(geom) for j, ring in enumerate(part) for k, (a, b) in enumerate(zip(ring, ring[1:]))]
    out, touching = set(), {}
    for (i, j, k, a, b, last), (m, n, o, c, d, _) in combinations(edges, 2):
        same, part = (i, j) == (m, n), i == m
        s = side(a, c, d), side(b, c, d), side(c, a, b), side(d, a, b)
        shared = [min(max(a[x], b[x]), max(c[x], d[x])) - max(min(a[x], b[x]), min(c[x], d[x])) for x in (0, 1)]
        if s[0] * s[1] < 0 and s[2] * s[3] < 0:
            out.add("self_crossing" if same else "rings_crossing" if part else "parts_overlapping")
        elif s == (0, 0, 0, 0) and min(shared) >= 0 and sum(shared) > 0:
            out.add("overlapping_edges")
        else:
            points = {p for p, z, e, f in ((a, s[0], c, d), (b, s[1], c, d), (c, s[2], a, b), (d, s[3], a, b)) if z == 0 and between(p, e, f)}
            if points and same and not (o - k == 1 or (k == 0 and o == last)):
                out.add("self_touching")
            elif points and not same:
                touching.setdefault(((i, j), (m, n)), set()).update(points)
    if any(len(p) > 1 and x[0] == y[0] for (x, y), p in touching.items()):
        out.add("rings_touching_twice")
    free = lambda ring, others: next((p for p in [*ring, *(((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(ring, ring[1:]))] if not any(on_ring(p, o) for o in others)), None)
    for part in geom:
        for hole in part[1:]:
            p = free(hole, [part[0]])
            if p and not inside(p, part[0]):
                out.add("hole_outside")
        for x, y in combinations(part[1:], 2):
            if any((p := free(u, [v])) and inside(p, v) for u, v in ((x, y), (y, x))):
                out.add("holes_nested")
    for one in geom:
        for other in geom:
            if one is not other:
                fine = [(a[0] + (b[0] - a[0]) * t / 24, a[1] + (b[1] - a[1]) * t / 24) for ring in one for a, b in zip(ring, ring[1:]) for t in range(25)]
                if any(sum(inside(p, r) for r in other) % 2 and not any(on_ring(p, r) for r in other) for p in fine):
                    out.add("parts_overlapping")
    return out


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


NAMED = [
    (None, "no_geometry"),
    ([], "no_geometry"),
    ([[box(0, 0, 9, 9)]], None),
    ([[[(0, 0), (4, 4), (4, 0), (0, 5), (0, 0)]]], "self_crossing"),
    ([[[(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0)]]], "self_touching"),
    ([[[(0, 0), (8, 0), (8, 8), (4, 0), (0, 8), (0, 0)]]], "self_touching"),
    ([[[(0, 0), (8, 0), (8, 8), (8, 12), (8, 8), (0, 8), (0, 0)]]], "overlapping_edges"),
    ([[box(0, 0, 9, 9), box(2, 2, 3, 3)]], None),
    ([[box(0, 0, 9, 9), box(20, 2, 3, 3)]], "hole_outside"),
    ([[box(0, 0, 9, 9), box(7, 2, 5, 3)]], "rings_crossing"),
    ([[box(0, 0, 9, 9), [(9, 4), (6, 2), (6, 6), (9, 4)]]], None),
    ([[box(0, 0, 9, 9), [(9, 4), (12, 2), (12, 6), (9, 4)]]], "hole_outside"),
    ([[box(0, 0, 9, 9), [(9, 4), (4, 0), (0, 4), (9, 4)]]], "rings_touching_twice"),
    ([[box(0, 0, 9, 9), box(0, 2, 3, 3)]], "overlapping_edges"),
    ([[box(0, 0, 9, 9), box(1, 1, 6, 6), box(2, 2, 2, 2)]], "holes_nested"),
    ([[box(0, 0, 9, 9)], [box(20, 0, 9, 9)]], None),
    ([[box(0, 0, 9, 9)], [box(9, 9, 9, 9)]], None),
    ([[box(0, 0, 9, 9)], [box(9, 0, 9, 9)]], "overlapping_edges"),
    ([[box(0, 0, 9, 9)], [box(5, 5, 9, 9)]], "parts_overlapping"),
    ([[box(0, 0, 9, 9)], [box(2, 2, 2, 2)]], "parts_overlapping"),
    ([[box(0, 0, 9, 9), box(1, 1, 6, 6)], [box(2, 2, 2, 2)]], None),
    ([[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]], [[(-2, 6), (6, -2), (6, 6), (-2, 6)]]], "parts_overlapping"),  # through two corners
    ([[[(0, 0), (0, 0), (4, 0), (4, 0), (4, 4), (0, 0)]]], None),
    ([[[(0, 0), (4, 0), (4, 4), (0, 4)]]], "open_ring"),
    ([[[(0, 0), (1, 1), (2, 2), (0, 0)]]], "no_area"),
]


def test_named_problems(spark):
    found = topology.geometry_problems(frame(spark, [g for g, _ in NAMED]), ["k"])
    assert {r["k"]: r["problem"] for r in found.collect()} == {k: p for k, (_, p) in enumerate(NAMED)}


def test_like_all_edges(spark):
    random.seed(11)

    def ring(n, span, x=0, y=0):
        corners = [(x + random.randrange(span), y + random.randrange(span)) for _ in range(n)]
        if random.random() < 0.7:  # in order round the middle, so that few edges cross
            cx, cy = sum(p[0] for p in corners) / n + 0.1, sum(p[1] for p in corners) / n + 0.1
            corners.sort(key=lambda p: math.atan2(p[1] - cy, p[0] - cx))
        return [*corners, corners[0]]

    geoms = []
    while len(geoms) < 220:
        geom = [[ring(random.randint(3, 7), 9, 7 * p, 0), *(ring(3, 5, 7 * p + random.randrange(-2, 5), random.randrange(-1, 6)) for _ in range(random.choice([0, 0, 1, 2])))] for p in range(random.choice([1, 1, 2]))]
        tidy = [[[p for k, p in enumerate(r) if not k or p != r[k - 1]] for r in part] for part in geom]
        if all(len(r) >= 4 and sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:])) for part in tidy for r in part):
            geoms.append(tidy)
    geoms += [[[box(k, k, 12, 12), box(k + 1 + k % 4, k + 2, 3, 3), box(k + 6, k + 2 + k % 3, 2, 5)], [box(k + 13 + k % 3, k, 4, 9)]] for k in range(40)]
    found = {r["k"]: r["problem"] for r in topology.geometry_problems(frame(spark, geoms), ["k"]).collect()}
    for k, geom in enumerate(geoms):
        problems = brute(geom)
        assert found[k] in problems if problems else found[k] is None, (geom, found[k], problems)
    assert sum(p is None for p in found.values()) > 20 and len(set(found.values())) > 6


def wavy(n, radius=10.0, wave=0.02):
    points = [((radius + wave * (k % 2)) * math.cos(2 * math.pi * k / n), (radius + wave * (k % 2)) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [*points, points[0]]


def test_cell_pairs_are_linear(spark):
    n = 20_000
    one = frame(spark, [[[wavy(n)]]])
    assert topology.geometry_problems(one, ["k"]).first()["problem"] is None
    width = F.lit(2 * 8 * 10.0 / n)
    edges = topology.ring_edges(one, ["k"], "geom").withColumns({"width": width, "height": width})
    assert n <= topology.edge_pairs(edges, ["k"]).count() < 20 * n


@pytest.mark.parametrize("cell", [0.7, 3.0, 40.0])
def test_points_like_whole_ray_casts(spark, monkeypatch, cell):
    monkeypatch.setattr(topology, "CROWD", 20)
    random.seed(2)
    geoms = [g for g, p in NAMED if p is None and g] + [[[wavy(50, 6.0, 2.0), box(-1, -1, 2, 2)], [box(1, 1, 9, 2)]], [[[(-5, -5), (5, 5), (5, -5), (-5, 5), (-5, -5)]]]]
    polygons = frame(spark, geoms).withColumn("name", F.lit("x"))
    spots = [(k, random.uniform(-8, 20), random.uniform(-8, 20)) for k in range(600)] + [(1000 + k, 2.5, 2.5) for k in range(40)] + [(2000, None, 1.0)]
    points = spark.createDataFrame(spots, "p int, lon double, lat double")
    found = topology.points_in_polygons(points, polygons, cell)
    assert found.columns == ["p", "lon", "lat", "k", "name"]
    got = sorted((r["p"], r["k"]) for r in found.collect())
    whole = points.crossJoin(polygons).where(geo.inside(F.col("lon"), F.col("lat"), F.col("geom")))
    assert got == sorted((r["p"], r["k"]) for r in whole.collect()) and len(got) > 500


def test_index_is_about_as_large_as_the_polygon(spark):
    n = 50_000
    index = topology.cell_index(frame(spark, [[[wavy(n)]]]), "k", 0.25)
    held = index.select(F.explode("parts").alias("p"), "cx", "cy").select("p.corner", F.size("p.edges").alias("n"))
    sums = held.agg(F.sum("n").alias("edges"), F.count("*").alias("cells"), F.count_if(F.col("corner") & (F.col("n") == 0)).alias("full")).first()
    assert n <= sums["edges"] < 1.1 * n  # an edge lies in one cell, or passes into the next
    assert sums["cells"] < 1.2 * math.pi * (10 / 0.25) ** 2 and sums["full"] > 0.8 * sums["cells"]


def test_few_points_are_compared_in_place(spark, monkeypatch):

    random.seed(4)
    point = "struct<lon:double,lat:double>"
    ring = lambda n: (lambda r: [*r, r[0]])([(float(random.randint(0, 6)), float(random.randint(0, 6))) for _ in range(n)])
    shapes = [[[ring(random.randint(3, 7))]] for _ in range(150)] + [[[ring(4), ring(3)], [ring(3)]] for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(shapes)), f"k int, geom array<array<array<{point}>>>")
    written, real = {}, topology.stored
    monkeypatch.setattr(topology, "stored", lambda frame, label: written.setdefault(label, real(frame, label)))
    found = {r["k"]: r["problem"] for r in topology.geometry_problems(df, ["k"]).collect()}
    assert written["edges"].where("k < 150").isEmpty() and not written["edges"].isEmpty()
    monkeypatch.setattr(topology, "stored", real)
    monkeypatch.setattr(topology, "FEW", 0)
    assert found == {r["k"]: r["problem"] for r in topology.geometry_problems(df, ["k"]).collect()} and len(set(found.values())) > 4
