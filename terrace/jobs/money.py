"""Money-market series of the central bank: interbank rates, overnight index, treasury rates, auctions, bank density."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import casts
from terrace.operators.dedup import dedup_latest
from terrace.operators.enrich import full_series
from terrace.operators.quarantine import key_present, tag_rejects
from terrace.sources.sinks import upsert_update

DATED = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"


def number(x: Column) -> Column:
    """Decimal of '1 234,5 %'; '-' and blanks stand for no activity."""
    return casts.placeholder_decimal(F.replace(x, F.lit(" "), F.lit("")))


def dated_series(bronze: DataFrame, key: str, days: list[str], numbers: dict[str, str], texts: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose ``key`` looks like a date, with typed days and numbers (new name: column)."""
    typed = {d: casts.to_date_fr(F.col(d)) for d in days} | {n: number(F.col(c)) for n, c in numbers.items()}
    return bronze.where(F.col(key).rlike(DATED)).select(*texts, *(c.alias(n) for n, c in typed.items()))


def undated(bronze: DataFrame, key: str) -> DataFrame:
    """The rows that ``dated_series`` leaves out, as they came, with the reason."""
    holds = F.col(key).rlike(DATED)
    return tag_rejects(bronze, [(f"{key} invalide (attendu JJ/MM/AAAA)", holds)]).where("reject_reason IS NOT NULL")


def silver_index(bronze: DataFrame) -> DataFrame:
    return dated_series(bronze, "date_reference", ["date_reference", "date_publication"], {"indice_monia_pct": "indice_monia", "volume_jj_mdh": "volume_jj"})


def silver_interbank_market(bronze: DataFrame) -> DataFrame:
    return dated_series(bronze, "date_operation", ["date_operation"], {"taux_moyen_pondere_pct": "taux_moyen_pondere", "volume_jj_mdh": "volume_jj", "encours_mdh": "encours"})


def silver_treasury(bronze: DataFrame) -> DataFrame:
    return dated_series(bronze, "date_echeance", ["date_echeance", "date_valeur"], {"transaction_mdh": "transaction_mdh", "taux_moyen_pondere_pct": "taux_moyen_pondere"})


def silver_auctions(bronze: DataFrame) -> DataFrame:
    amounts = ("montant_demande", "cours_min", "cours_max", "montant_alloue", "cours_marginal", "cours_moyen_pondere")
    return dated_series(bronze, "date_adjudication", ["date_adjudication", "date_valeur"], {c: c for c in amounts}, ("devise", "sens_operation"))


def silver_interbank_rates(bronze: DataFrame) -> DataFrame:
    """Bid and ask by maturity; rows without a maturity are dropped."""
    return bronze.where(key_present("maturite")).select("maturite", number(F.col("taux_bid")).alias("taux_bid_pct"), number(F.col("taux_ask")).alias("taux_ask_pct"))


def silver_density(bronze: DataFrame) -> DataFrame:
    """Bank density by year of report, typed and tagged."""
    year = F.col("annee_rapport")
    tagged = tag_rejects(bronze.where(year.isNotNull()), [("annee_rapport invalide", year.rlike("^(19|20)[0-9]{2}$"))])  # fixed value: the reason
    money = {c: casts.to_double_fr(F.col(c)) for c in ("densite_bancaire", "agences_pour_10000_habitants")}
    return tagged.select(year.try_cast("int").alias("annee_rapport"), year.alias("annee_brute"), casts.to_int_fr(F.col("nombre_agences_bancaires")).alias("nombre_agences_bancaires"), *(x.alias(c) for c, x in money.items()), "reject_reason")


def upsert_density(existing: DataFrame | None, tagged: DataFrame) -> DataFrame:
    """Valid years merged into the table; of rows of one year that with the most agencies counts."""
    valid = tagged.where("reject_reason IS NULL").drop("reject_reason", "annee_brute")
    order = [F.desc_nulls_last("nombre_agences_bancaires"), F.desc_nulls_last("densite_bancaire")]
    return upsert_update(existing if existing is not None else valid.limit(0), valid, ["annee_rapport"], order)


def money_market(index: DataFrame, interbank: DataFrame) -> DataFrame:
    """Overnight index and interbank market side by side, one row a day; days that only one series has are kept."""
    a = dedup_latest(index, ["date_reference"], [F.desc_nulls_last("indice_monia_pct"), F.desc_nulls_last("volume_jj_mdh")])
    b = dedup_latest(interbank, ["date_operation"], [F.desc_nulls_last("taux_moyen_pondere_pct"), F.desc_nulls_last("volume_jj_mdh"), F.desc_nulls_last("encours_mdh")])
    a = a.select(F.col("date_reference").alias("date_id"), "indice_monia_pct")
    b = b.select(F.col("date_operation").alias("date_id"), F.col("taux_moyen_pondere_pct").alias("taux_moyen_pondere_interbancaire"), F.col("volume_jj_mdh").alias("volume_jj_interbancaire_mdh"), F.col("encours_mdh").alias("encours_interbancaire_mdh"))
    return full_series(a.where("date_id IS NOT NULL"), b.where("date_id IS NOT NULL"), "date_id")
