"""Business listings: one row a place and category, ratings by zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import casts, geo
from terrace.functions.text import split_types
from terrace.operators.dedup import dedup_latest
from terrace.operators.enrich import lookup
from terrace.operators.quarantine import key_present, tag_rejects


def silver_listings(bronze: DataFrame) -> DataFrame:
    """Typed listings, tagged; missing coordinates are rejected as not numeric."""
    lat, lon = casts.to_double(F.col("lat")), casts.to_double(F.col("lon"))
    # Reasons and their order.
    rules = [
        ("place_id_manquant", key_present("place_id")),
        ("lat_lon_non_numerique", lat.isNotNull() & lon.isNotNull()),
        ("lat_hors_plage", lat.between(-90, 90)),
        ("lon_hors_plage", lon.between(-180, 180)),
    ]
    typed = {"types": split_types(F.col("types")), "lat": lat, "lon": lon, "rating": F.nullif(F.trim("rating"), F.lit("")).try_cast("decimal(4,2)"), "user_rating_count": casts.to_int(F.col("user_rating_count")).cast("int")}
    tagged = tag_rejects(bronze, rules)
    return tagged.withColumns(typed).withColumn("geom", geo.point(F.col("lon"), F.col("lat")))


def run(bronze: DataFrame, zones: DataFrame | None = None) -> dict[str, DataFrame]:
    tagged = silver_listings(bronze)
    valid = tagged.where("reject_reason IS NULL").drop("reject_reason")
    silver = dedup_latest(valid, ["place_id", "category"], [F.desc("rating"), F.col("display_name"), F.col("commune_code")])
    cents = F.sum((F.col("rating") * 100).cast("bigint"))
    grouped = silver.groupBy("commune_code", "commune_nom", "category").agg(F.count("*").alias("nb_places"), cents.alias("_s"), F.count("rating").alias("_n"))
    # half away from zero in whole hundredths
    gold = grouped.withColumn("note_moyenne", F.expr("CAST(sign(_s) * ((2 * abs(_s) + _n) DIV (2 * nullif(_n, 0))) AS DOUBLE) / 100")).drop("_s", "_n")
    dim = None if zones is None else zones.select(F.col("code").alias("commune_code"), F.col("nom").alias("zone_nom"))
    return {"silver_listings": silver, "rejects": tagged.where("reject_reason IS NOT NULL"), "places_by_zone": lookup(gold, dim, "commune_code", ["zone_nom"])}
