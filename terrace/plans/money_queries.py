"""Queries of the money-market jobs; the raw texts are made of orders, line items, parts and suppliers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrace.jobs import money
from terrace.plans.registry import french, query, table


def _blanked(c: str) -> Column:
    """'12 345' of a whole number."""
    return F.concat(F.floor(F.col(c) / 1000).cast("string"), F.lit(" "), F.lpad((F.col(c) % 1000).cast("string"), 3, "0"))


def _day(c: str, bad: Column) -> Column:
    return F.when(bad, F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "dd/MM/yyyy"))


def _index(spark, d):
    k = F.col("o_orderkey")
    rate = F.when(k % 5 == 0, "-").when(k % 7 == 0, " ").otherwise(F.concat(french("o_totalprice"), F.lit(" %")))
    return table(spark, d, "orders").select(_day("o_orderdate", k % 11 == 0).alias("date_reference"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("date_publication"), rate.alias("indice_monia"), F.when(k % 3 == 0, "-").otherwise(_blanked("o_custkey")).alias("volume_jj"))


def _market(spark, d):
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return table(spark, d, "lineitem").select(_day("l_shipdate", k % 9 == 0).alias("date_operation"), F.concat(french("l_tax"), F.lit("%")).alias("taux_moyen_pondere"), F.when(k % 4 == 0, "").otherwise(_blanked("l_partkey")).alias("volume_jj"), _blanked("l_suppkey").alias("encours"))


_INDEX = """SELECT CAST(o_orderdate AS DATE) AS date_reference, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(38,6)) END AS indice_monia_pct,
CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS DECIMAL(38,6)) END AS volume_jj_mdh FROM orders WHERE o_orderkey % 11 <> 0"""
_MARKET = """SELECT CAST(l_shipdate AS DATE) AS date_operation, CAST(CAST(l_tax AS DECIMAL(14,2)) AS DECIMAL(38,6)) AS taux_moyen_pondere_pct,
CASE WHEN (l_orderkey + l_linenumber) % 4 <> 0 THEN CAST(l_partkey AS DECIMAL(38,6)) END AS volume_jj_mdh, CAST(l_suppkey AS DECIMAL(38,6)) AS encours_mdh FROM lineitem WHERE (l_orderkey + l_linenumber) % 9 <> 0"""


@query(_INDEX)
def job_overnight_index(spark, d):
    return money.silver_index(_index(spark, d)).drop("date_publication")


@query(_MARKET)
def job_interbank_market(spark, d):
    return money.silver_interbank_market(_market(spark, d))


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS date_reference, 'date_reference invalide (attendu JJ/MM/AAAA)' AS reject_reason FROM orders WHERE o_orderkey % 11 = 0")
def job_overnight_index_rejects(spark, d):
    return money.undated(_index(spark, d), "date_reference").select("date_reference", "reject_reason")


@query("SELECT strftime(l_shipdate, '%Y-%m-%d') AS date_operation, 'date_operation invalide (attendu JJ/MM/AAAA)' AS reject_reason FROM lineitem WHERE (l_orderkey + l_linenumber) % 9 = 0")
def job_interbank_market_rejects(spark, d):
    return money.undated(_market(spark, d), "date_operation").select("date_operation", "reject_reason")


@query(f"""WITH a AS (SELECT date_reference AS date_id, indice_monia_pct, row_number() OVER (PARTITION BY date_reference ORDER BY indice_monia_pct DESC NULLS LAST, volume_jj_mdh DESC NULLS LAST) AS k FROM ({_INDEX})),
b AS (SELECT *, row_number() OVER (PARTITION BY date_operation ORDER BY taux_moyen_pondere_pct DESC NULLS LAST, volume_jj_mdh DESC NULLS LAST, encours_mdh DESC NULLS LAST) AS k FROM ({_MARKET}))
SELECT coalesce(a.date_id, b.date_operation) AS date_id, indice_monia_pct, taux_moyen_pondere_pct AS taux_moyen_pondere_interbancaire, volume_jj_mdh AS volume_jj_interbancaire_mdh, encours_mdh AS encours_interbancaire_mdh
FROM (SELECT * FROM a WHERE k = 1) a FULL JOIN (SELECT * FROM b WHERE k = 1) b ON a.date_id = b.date_operation""")
def job_money_market(spark, d):
    return money.money_market(money.silver_index(_index(spark, d)), money.silver_interbank_market(_market(spark, d)))


@query("""SELECT CAST(l_shipdate AS DATE) AS date_echeance, CAST(l_shipdate AS DATE) AS date_valeur, CASE WHEN l_linenumber <> 2 THEN CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS DECIMAL(38,6)) END AS transaction_mdh,
CASE WHEN l_linenumber <> 3 THEN CAST(CAST(l_discount AS DECIMAL(14,2)) AS DECIMAL(38,6)) END AS taux_moyen_pondere_pct FROM lineitem WHERE l_linenumber <> 4""")
def job_treasury_rates(spark, d):
    n = F.col("l_linenumber")
    bronze = table(spark, d, "lineitem").select(F.when(n == 4, "").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("date_echeance"), F.date_format("l_shipdate", "dd/MM/yyyy").alias("date_valeur"), F.when(n == 2, " - ").otherwise(french("l_extendedprice")).alias("transaction_mdh"), F.when(n == 3, "-").otherwise(F.concat(french("l_discount"), F.lit("%"))).alias("taux_moyen_pondere"))
    return money.silver_treasury(bronze)


@query("""SELECT 'C' || (o_custkey % 50) AS devise, o_orderstatus AS sens_operation, CAST(o_orderdate AS DATE) AS date_adjudication, CAST(o_custkey AS DECIMAL(38,6)) AS montant_demande,
CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(38,6)) END AS cours_min, NULL::DECIMAL(38,6) AS cours_max FROM orders WHERE o_orderkey % 11 <> 0""")
def job_currency_auctions(spark, d):
    k = F.col("o_orderkey")
    price = F.when(k % 5 == 0, "-").otherwise(french("o_totalprice"))
    bronze = table(spark, d, "orders").select(_day("o_orderdate", k % 11 == 0).alias("date_adjudication"), F.lit(None).cast("string").alias("date_valeur"), F.concat(F.lit("C"), (F.col("o_custkey") % 50).cast("string")).alias("devise"), F.col("o_orderstatus").alias("sens_operation"), _blanked("o_custkey").alias("montant_demande"), price.alias("cours_min"), *(F.lit("-").alias(c) for c in ("cours_max", "montant_alloue", "cours_marginal", "cours_moyen_pondere")))
    return money.silver_auctions(bronze).select("devise", "sens_operation", "date_adjudication", "montant_demande", "cours_min", "cours_max")


@query("""SELECT p_brand AS maturite, CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS DECIMAL(38,6)) AS taux_bid_pct, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DECIMAL(38,6)) END AS taux_ask_pct FROM part WHERE p_partkey % 6 <> 0""")
def job_interbank_rates(spark, d):
    bronze = table(spark, d, "part").select(F.when(F.col("p_partkey") % 6 == 0, "  ").otherwise(F.col("p_brand")).alias("maturite"), F.concat(french("p_retailprice"), F.lit("%")).alias("taux_bid"), F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_size").cast("string"), F.lit("%"))).otherwise("").alias("taux_ask"))
    return money.silver_interbank_rates(bronze)


def _density(spark, d):
    k = F.col("s_suppkey")
    year = F.when(k % 10 == 0, F.concat(F.lit("18"), F.lpad((k % 100).cast("string"), 2, "0"))).otherwise((F.lit(1950) + k % 80).cast("string"))
    return money.silver_density(table(spark, d, "supplier").select(year.alias("annee_rapport"), _blanked("s_suppkey").alias("nombre_agences_bancaires"), french("s_acctbal").alias("densite_bancaire"), F.lit("1,6").alias("agences_pour_10000_habitants")))


@query("""SELECT CAST(1950 + s_suppkey % 80 AS INT) AS annee_rapport, CAST(max(s_suppkey) AS BIGINT) AS nombre_agences_bancaires, arg_max(CAST(CAST(s_acctbal AS DECIMAL(14,2)) AS DOUBLE), s_suppkey) AS densite_bancaire, CAST(1.6 AS DOUBLE) AS agences_pour_10000_habitants
FROM supplier WHERE s_suppkey % 10 <> 0 GROUP BY 1950 + s_suppkey % 80""")
def job_bank_density(spark, d):
    return money.upsert_density(None, _density(spark, d))


@query("SELECT '18' || lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0') AS annee_brute, 'annee_rapport invalide' AS reject_reason FROM supplier WHERE s_suppkey % 10 = 0")
def job_bank_density_rejects(spark, d):
    return _density(spark, d).where("reject_reason IS NOT NULL").select("annee_brute", "reject_reason")
