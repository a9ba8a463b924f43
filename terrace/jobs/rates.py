"""Central-bank series: page to upsert to star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import casts
from terrace.functions.text import month_name_fr
from terrace.operators.quarantine import key_present, tag_rejects
from terrace.sources.sinks import surrogate_key, upsert_ignore, upsert_update


def silver_rates(bronze: DataFrame) -> DataFrame:
    """Exchange rates, typed and tagged; a placeholder is told apart from garbage."""
    rate, day = casts.to_double_fr(F.col("cours_moyen")), casts.to_date_fr(F.col("date_cours"))
    # Reasons and their order.
    rules = [
        ("devise_code manquant", key_present("devise_code")),
        ("date_cours invalide (attendu JJ/MM/AAAA)", day.isNotNull()),
        ("cours_moyen absent", F.trim("cours_moyen") != "-"),
        ("cours_moyen non numerique", rate.isNotNull()),
    ]
    tagged = tag_rejects(bronze, rules)
    return tagged.select(F.trim("devise_code").alias("devise_code"), F.trim("devise_libelle").alias("devise_libelle"), casts.unit_or_one(F.col("unite")).alias("unite"), day.alias("date_cours"), rate.alias("cours_moyen"), F.col("date_cours").alias("date_brute"), F.col("cours_moyen").alias("cours_brut"), "reject_reason")


def upsert_rates(existing: DataFrame | None, tagged: DataFrame) -> DataFrame:
    """Valid rates merged into the silver table on (currency, day)."""
    valid = tagged.where("reject_reason IS NULL").select("devise_code", "devise_libelle", "unite", "date_cours", "cours_moyen")
    order = [F.desc("cours_moyen"), F.col("devise_libelle")]
    return upsert_update(existing if existing is not None else valid.limit(0), valid, ["devise_code", "date_cours"], order)


def silver_decisions(bronze: DataFrame) -> DataFrame:
    """Policy-rate decisions, typed and tagged, one a day."""
    day, rate = casts.to_date_fr(F.col("date_decision")), casts.to_double_fr(F.col("taux_directeur"))
    # Reasons and their order.
    tagged = tag_rejects(bronze, [("date_decision invalide (attendu JJ/MM/AAAA)", day.isNotNull()), ("taux_directeur non numerique", rate.isNotNull())])
    return tagged.select(day.alias("date_decision"), rate.alias("taux_directeur"), casts.to_double_fr(F.col("ratio_reserve_obligatoire")).alias("ratio_reserve_obligatoire"), "reject_reason")


def silver_credit(bronze: DataFrame, code: str, label: str) -> DataFrame:
    """Monthly deposits and credits of a zone, typed and tagged."""
    period = casts.to_date_period(F.col("periode"))
    # Reasons and their order.
    tagged = tag_rejects(bronze, [("code manquant", key_present(code)), ("periode invalide (attendu MM-AAAA)", period.isNotNull())])
    money = {c: casts.to_double_fr(F.col(c)) for c in ("depots_montant", "depots_percent", "credits_montant", "credits_percent")}
    return tagged.select(F.trim(code).alias("code_zone"), F.trim(label).alias("libelle_zone"), period.alias("periode"), casts.to_int_fr(F.col("nombre_guichets")).alias("nombre_guichets"), *(x.alias(c) for c, x in money.items()), "reject_reason")


def dim_date(days: list[DataFrame]) -> DataFrame:
    """Calendar of all days that occur in the given one-column tables."""
    every = reduce(DataFrame.union, (d.toDF("date_id") for d in days)).where("date_id IS NOT NULL").distinct()
    return every.select("date_id", F.year("date_id").alias("annee"), F.month("date_id").alias("mois"), F.quarter("date_id").alias("trimestre"), month_name_fr(F.col("date_id")).alias("libelle_mois"))


def dim_zone(grains: dict[str, DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """(zone_id, granularite, code_zone, libelle_zone): known zones stay, new ones are added, one a code."""
    found = reduce(DataFrame.unionByName, (z.select(F.lit(g).alias("granularite"), "code_zone", "libelle_zone").distinct() for g, z in grains.items()))
    base = existing if existing is not None else found.limit(0)
    merged = upsert_ignore(base.select("granularite", "code_zone", "libelle_zone"), found, ["granularite", "code_zone"], [F.col("libelle_zone")])
    return surrogate_key(merged, ["granularite", "code_zone"], "zone_id")


def credit_facts(grains: dict[str, DataFrame], zones: DataFrame) -> DataFrame:
    """Deposits and credits of both grains with the zone's key."""
    parts = []
    for grain, rows in grains.items():
        keys = zones.where(F.col("granularite") == grain).select("zone_id", "code_zone")
        parts.append(rows.join(keys, "code_zone").select(F.col("periode").alias("periode_id"), "zone_id", "nombre_guichets", "depots_montant", "depots_percent", "credits_montant", "credits_percent"))
    return reduce(DataFrame.unionByName, parts)


def run(bronze_rates: DataFrame, bronze_decisions: DataFrame, existing: DataFrame | None = None) -> dict[str, DataFrame]:
    tagged, decided = silver_rates(bronze_rates), silver_decisions(bronze_decisions)
    silver = upsert_rates(existing, tagged)
    decisions = decided.where("reject_reason IS NULL").drop("reject_reason")
    decisions = upsert_ignore(decisions.limit(0), decisions, ["date_decision"], [F.desc("taux_directeur")])
    currencies = silver.groupBy("devise_code").agg(F.min("devise_libelle").alias("devise_libelle"))
    return {
        "silver_rates": silver,
        "rejects": tagged.where("reject_reason IS NOT NULL"),
        "dim_date": dim_date([silver.select("date_cours"), decisions.select("date_decision")]),
        "dim_devise": currencies,
        "fact_taux_change": silver.select(F.col("date_cours").alias("date_id"), "devise_code", "cours_moyen"),
        "fact_politique_monetaire": decisions.withColumnRenamed("date_decision", "date_id"),
    }
