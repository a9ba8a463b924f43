"""Census indicators by zone (JOB-5, and the lifecycle raw CSV to gold)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from terrace.functions import casts, geo
from terrace.functions.text import deepest_code
from terrace.operators import quality
from terrace.operators.dedup import dedup_latest
from terrace.operators.enrich import mark_existing, prefix_match
from terrace.operators.monitoring import outcomes
from terrace.operators.quarantine import tag_rejects

# Zones of the dashboard's tree that are outside the statistical scope, in lower case.
OUT_OF_SCOPE = ("sebta", "mellilia", "melilla")
ROOT_CODE = "MA"


#: What becomes of a row when themes are consolidated.
OUTCOMES = ("kept", "empty", "unmatched")


def consolidate(themes: DataFrame, zones: DataFrame, key: str = "code", value: str = "valeur") -> tuple[DataFrame, Observation]:
    """(long rows with their zone's attributes, counters): empty cells are dropped and counted, as are rows without a zone.

    The counters, for ``monitoring.counters`` with OUTCOMES, come with the first action over the rows.
    """
    known = zones.select(key, *(c for c in zones.columns if c != key and c not in themes.columns)).withColumn("_zone", F.lit(True))
    joined = themes.join(known, key, "left")
    empty = F.coalesce(F.trim(F.col(value)), F.lit("")) == ""
    tagged = joined.withColumn("_outcome", F.when(empty, "empty").when(F.col("_zone").isNull(), "unmatched").otherwise("kept"))
    watched, seen = outcomes(tagged, "_outcome", OUTCOMES)
    return watched.where("_outcome = 'kept'").drop("_zone", "_outcome"), seen


def silver_zones(bronze: DataFrame, boundaries: DataFrame | None = None) -> DataFrame:
    """One row a zone: its deepest code, a point, whether it is out of scope, and the boundary whose name begins with its own.

    Of rows with one code the least by level and name counts. The country itself is added, so that
    national figures have a zone.
    """
    code = deepest_code(*(F.col(c) for c in ("code_commune", "code_province", "code_region", "code_pays")))
    lon, lat = casts.to_double(F.col("centroid_lon")), casts.to_double(F.col("centroid_lat"))
    zones = bronze.select(code.alias("code"), "niveau", "nom", F.nullif("code_province", F.lit("")).alias("code_province"), F.nullif("code_region", F.lit("")).alias("code_region"), F.coalesce(F.lower(F.trim("nom")).isin(*OUT_OF_SCOPE), F.lit(False)).alias("hors_perimetre"), geo.point(lon, lat).alias("geom")).where("code IS NOT NULL")
    root = bronze.sparkSession.createDataFrame([(ROOT_CODE, "pays", "Maroc", None, None, False, None)], zones.schema)
    zones = dedup_latest(zones.unionByName(root), ["code"], [F.col("niveau"), F.col("nom")])
    if boundaries is None:
        return zones.withColumn("boundary_id", F.lit(None).cast("string"))
    return prefix_match(zones, boundaries, "nom", "name", "niveau", "osm_id").withColumnRenamed("matched_id", "boundary_id").drop("matched_name")


def silver_indicators(bronze: DataFrame, zones: DataFrame) -> DataFrame:
    """Typed rows tagged with the reason of the first broken rule."""
    value = F.col("valeur")
    # Reasons, and the shape of a number.
    rules = [
        ("code_zone_inconnu", F.col("_zone")),
        ("indicateur_vide", F.trim("indicateur") != ""),
        ("valeur_non_numerique", value.isNull() | value.rlike(r"^-?[0-9]+([.][0-9]+)?$")),
    ]
    tagged = tag_rejects(mark_existing(bronze, zones, "code", "_zone"), rules).drop("_zone")
    return tagged.withColumns({"milieu": F.nullif("milieu", F.lit("")), "sexe": F.nullif("sexe", F.lit("")), "valeur_brute": value, "valeur": value.try_cast("decimal(38,6)")})


def run(bronze_indicators: DataFrame, bronze_zones: DataFrame, boundaries: DataFrame | None = None) -> dict[str, DataFrame]:
    zones = silver_zones(bronze_zones, boundaries)
    tagged = silver_indicators(bronze_indicators, zones)
    dim = zones.where(~F.col("hors_perimetre")).drop("hors_perimetre")
    valid = tagged.where("reject_reason IS NULL").drop("reject_reason", "valeur_brute")
    fact = valid.join(dim.select("code"), "code")
    checks = quality.completeness(dim, "dim_census_zone", ["code", "nom"]).unionByName(quality.coverage(dim, "dim_census_zone", "geom")).unionByName(quality.uniqueness(dim, "dim_census_zone", ["code"])).unionByName(quality.referential(dim.where("niveau = 'commune'"), fact, "fact_indicateurs", "code", "code"))
    return {"silver_zones": zones, "silver_indicators": valid, "rejects": tagged.where("reject_reason IS NOT NULL"), "dim_census_zone": dim, "fact_indicateurs": fact, "checks": checks}
