"""Points of interest inside administrative zones (JOB-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import casts, geo
from terrace.functions.text import to_tags
from terrace.operators import quality
from terrace.operators.dedup import dedup_latest
from terrace.operators.enrich import lookup
from terrace.operators.quarantine import key_present, tag_rejects
from terrace.operators.topology import geometry_problems, points_in_polygons
from terrace.sources.storage import stored


def silver_boundaries(bronze: DataFrame) -> DataFrame:
    """Boundaries with cleaned polygons, tagged; ids stay text."""
    geom = geo.cleaned(geo.multipolygon(F.col("geojson_geom")))
    typed = stored(bronze.withColumn("geom", geom).withColumn("_row", F.monotonically_increasing_id()), "boundaries")
    checked = typed.join(geometry_problems(typed, ["_row"]), "_row")
    rules = [("osm_id manquant", key_present("osm_id")), ("geometrie illisible", F.col("geom").isNotNull()), ("geometrie invalide", F.col("problem").isNull())]
    return tag_rejects(checked, rules).drop("_row", "problem")


def assign(points: DataFrame, boundaries: DataFrame, cell: float) -> DataFrame:
    """Points (lon, lat, ...) with the osm_id of the boundary around them, null without one."""
    held = points_in_polygons(points.select("osm_id", "osm_type", "lon", "lat"), boundaries.select(F.col("osm_id").alias("zone_osm_id"), "geom"), cell)
    zone = held.groupBy("osm_id", "osm_type").agg(F.min("zone_osm_id").alias("zone_osm_id"))
    return points.join(zone, ["osm_id", "osm_type"], "left")


def silver_pois(bronze: DataFrame) -> DataFrame:
    """Typed points, tagged."""
    lat, lon = casts.to_double(F.col("lat")), casts.to_double(F.col("lon"))
    # Reasons and their order.
    rules = [
        ("osm_id manquant/non numerique", casts.to_int(F.col("osm_id")).isNotNull()),
        ("osm_type invalide", F.trim("osm_type").isin("node", "way", "relation")),
        ("lat invalide", lat.between(-90, 90)),
        ("lon invalide", lon.between(-180, 180)),
        ("category_key manquante", key_present("category_key")),
    ]
    return tag_rejects(bronze, rules).select(
        F.nullif(F.trim("commune_code"), F.lit("")).alias("commune_code"), F.trim("commune_nom").alias("commune_nom"), casts.to_int(F.col("osm_id")).alias("osm_id"), F.trim("osm_type").alias("osm_type"), F.trim("category_key").alias("category_key"),
        F.trim("category_value").alias("category_value"), F.nullif(F.trim("poi_name"), F.lit("")).alias("poi_name"), lat.alias("lat"), lon.alias("lon"), to_tags(F.col("tags_json")).alias("tags"), "_ingested_at", "reject_reason",
    )


def run(bronze: DataFrame, zones: DataFrame | None = None) -> dict[str, DataFrame]:
    """``zones``: (code, nom) of communes, if they are loaded."""
    tagged = silver_pois(bronze)
    valid = tagged.where("reject_reason IS NULL").drop("reject_reason")
    silver = dedup_latest(valid, ["osm_id", "osm_type"], [F.desc("_ingested_at"), F.col("category_key"), F.col("category_value"), F.col("commune_code")])
    counts = silver.groupBy("commune_code", "commune_nom", "category_key").agg(F.count("*").alias("nb_pois"))
    dim = None if zones is None else zones.select(F.col("code").alias("commune_code"), F.col("nom").alias("zone_nom"))
    checks = quality.validity(silver, "silver_pois", "geometry valid", geo.point(F.col("lon"), F.col("lat")).isNotNull()).unionByName(quality.uniqueness(silver, "silver_pois", ["osm_id", "osm_type"]))
    return {"silver_pois": silver, "rejects": tagged.where("reject_reason IS NOT NULL"), "poi_counts": lookup(counts, dim, "commune_code", ["zone_nom"]), "checks": checks}
