"""Points and polygons as column builders (FN-28, FN-30 to FN-34, FN-36, AGG-11).

A point is struct<lon,lat>, a multipolygon array<array<array<struct<lon,lat>>>>: parts, rings, points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_WORLD = 20037508.34
EARTH_KM = 6371.0088
POINT = "struct<lon:double,lat:double>"


def own_or_center(kind: Column, own: Column, center: Column) -> Column:
    return F.when(kind == "node", own).otherwise(center)


def mercator_lon(x: Column) -> Column:
    return F.round(x / HALF_WORLD * 180, 6)


def mercator_lat(y: Column) -> Column:
    return F.round(F.degrees(2 * F.atan(F.exp(y / HALF_WORLD * math.pi)) - math.pi / 2), 6)


def point(lon: Column, lat: Column) -> Column:
    """Point of two numbers, null if either is missing or out of range."""
    return F.when(lon.between(-180, 180) & lat.between(-90, 90), F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat")))


def multipolygon(geojson: Column) -> Column:
    """Polygon or MultiPolygon text to a multipolygon; null for all else."""
    kind = F.get_json_object(geojson, "$.type")
    one = F.from_json(geojson, "coordinates array<array<array<double>>>")["coordinates"]
    many = F.from_json(geojson, "coordinates array<array<array<array<double>>>>")["coordinates"]
    parts = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)
    return F.transform(parts, lambda rings: F.transform(rings, lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat")))))


def edges(ring: Column) -> Column:
    """array<struct(a, b)> of consecutive points."""
    n = F.size(ring)
    return F.zip_with(F.slice(ring, 1, n - 1), F.slice(ring, 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def signed_area(ring: Column) -> Column:
    """Shoelace area of a closed ring."""
    return F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + (e["a"]["lon"] * e["b"]["lat"] - e["b"]["lon"] * e["a"]["lat"])) / 2


def part_area(rings: Column) -> Column:
    """Area of the outer ring without its holes."""
    holes = F.aggregate(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), F.lit(0.0), lambda s, r: s + F.abs(signed_area(r)))
    return F.abs(signed_area(F.get(rings, F.lit(0)))) - holes


def largest_part(geom: Column) -> Column:
    """The part of greatest area, the first of equals."""
    tagged = F.transform(geom, lambda p, i: F.struct(part_area(p).alias("area"), (-i).alias("at"), p.alias("part")))
    return F.element_at(F.array_sort(tagged, lambda a, b: F.when(a["area"] != b["area"], F.signum(a["area"] - b["area"]).cast("int")).otherwise((a["at"] - b["at"]).cast("int"))), -1)["part"]


def ring_problem(ring: Column) -> Column:
    """First failing rule of a ring by itself, or null; how edges meet is for ``operators.topology``."""
    n = F.size(ring)
    out = F.exists(ring, lambda p: ~F.coalesce(p["lon"].between(-180, 180) & p["lat"].between(-90, 90), F.lit(False)))
    return F.when(ring.isNull() | (n < 4), "too_few_points").when(out, "out_of_range").when(F.get(ring, F.lit(0)) != F.get(ring, n - 1), "open_ring").when(signed_area(ring) == 0, "no_area")


def simple_problem(geom: Column) -> Column:
    """First problem of a polygon's rings by themselves, or null."""
    problems = F.filter(F.transform(F.flatten(geom), ring_problem), lambda p: p.isNotNull())
    return F.when(geom.isNull() | (F.size(geom) == 0), "no_geometry").otherwise(F.get(problems, F.lit(0)))


def cleaned(geom: Column) -> Column:
    """Open rings closed, repeated points and rings without area dropped; crossing rings are left as they are."""

    def tidy(ring: Column) -> Column:
        single = F.filter(ring, lambda p, i: (i == 0) | (p != F.get(ring, i - 1)))
        return F.when(F.get(single, F.lit(0)) != F.get(single, F.size(single) - 1), F.concat(single, F.slice(single, 1, 1))).otherwise(single)

    parts = F.transform(geom, lambda rings: F.filter(F.transform(rings, tidy), lambda r: (F.size(r) >= 4) & (signed_area(r) != 0)))
    return F.filter(parts, lambda rings: F.size(rings) > 0)


def inside_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Even-odd ray cast; an edge holds its lower end and not its upper one."""

    def hit(e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (a["lat"] > lat) != (b["lat"] > lat)
        at = (b["lon"] - a["lon"]) * (lat - a["lat"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0)) + a["lon"]
        return spans & (lon < at)

    return F.aggregate(edges(ring), F.lit(False), lambda inside, e: inside != F.coalesce(hit(e), F.lit(False)))


def inside(lon: Column, lat: Column, geom: Column) -> Column:
    """Inside any part: inside an odd number of its rings."""
    return F.exists(geom, lambda rings: F.aggregate(rings, F.lit(False), lambda v, ring: v != inside_ring(lon, lat, ring)))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


# Fixed value: digits of the open grid code.
GRID_DIGITS = "23456789CFGHJMPQRVWX"


def decode_short_code(code: Column, ref_lat: Column, ref_lon: Column) -> Column:
    """struct(lat, lon): centre of a short grid code (4 digits, plus, 2 digits) nearest to a reference point.

    The four digits repeat every degree: pairs of base-20 digits give twentieths and four-hundredths
    of a degree, and the last pair eight-thousandths.
    """
    clean = F.upper(F.split(F.trim(code), " ")[0])
    valid = clean.rlike(f"^[{GRID_DIGITS}]{{4}}\\+[{GRID_DIGITS}]{{2}}$")
    digit = [(F.position(F.substring(clean, at, 1), F.lit(GRID_DIGITS)) - 1).cast("double") for at in (1, 2, 3, 4, 6, 7)]
    half = 1 / 16000

    def nearest(fraction: Column, ref: Column) -> Column:
        at = F.floor(ref) + fraction
        return F.when(at - ref > 0.5, at - 1).when(ref - at > 0.5, at + 1).otherwise(at)

    lat = nearest(digit[0] / 20 + digit[2] / 400 + digit[4] / 8000 + half, ref_lat)
    lon = nearest(digit[1] / 20 + digit[3] / 400 + digit[5] / 8000 + half, ref_lon)
    return F.when(valid, F.struct(lat.alias("lat"), lon.alias("lon")))
