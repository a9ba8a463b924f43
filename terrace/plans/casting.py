"""Queries of casts, text functions and the valid/reject split."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.functions import casts, text
from terrace.jobs import census
from terrace.operators import enrich, quarantine
from terrace.plans.registry import french, query, table, text2

#: Account balances as the listings show them: French numbers, a placeholder for each seventh customer.
_RATES = "CASE WHEN c_custkey % 7 = 0 THEN '-' ELSE replace(CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS VARCHAR), '.', ',') END"


def _rates(c):
    return c.withColumn("rate", F.when(F.col("c_custkey") % 7 == 0, "-").otherwise(french("c_acctbal")))


@query(f"""
WITH r AS (SELECT c_nationkey, c_mktsegment, {_RATES} AS rate FROM customer),
v AS (SELECT c_nationkey, c_mktsegment, CAST(CAST(replace(rate, ',', '.') AS DECIMAL(14,2)) * 100 AS BIGINT) AS x FROM r WHERE rate <> '-'),
g AS (SELECT c_nationkey, c_mktsegment, count(*) AS n, CAST(sum(x) AS BIGINT) AS s FROM v GROUP BY ALL)
SELECT c_nationkey, c_mktsegment, n AS n_rates, CAST(sign(s) * ((2 * abs(s) + n) // (2 * n)) AS DOUBLE) / 100 AS avg_rate, n_name, r_name
FROM g LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def flagship_rollup(spark, d):
    """Rates parsed, placeholders rejected, counted and averaged by group, names attached after the grouping."""
    rates = _rates(table(spark, d, "customer"))
    parsed = rates.withColumn("x", casts.placeholder_decimal(F.col("rate"), 2).cast("decimal(14,2)"))
    valid, _ = quarantine.split(parsed, [("rate missing", F.col("x").isNotNull())])
    grouped = valid.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n_rates"), F.sum((F.col("x") * 100).cast("bigint")).alias("cents"))
    # rounded half away from zero in whole cents, so that no engine's floating point decides a tie
    grouped = grouped.withColumn("avg_rate", F.expr("CAST(sign(cents) * ((2 * abs(cents) + n_rates) DIV (2 * n_rates)) AS DOUBLE) / 100")).drop("cents")
    nations = table(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return enrich.lookup(enrich.lookup(grouped, nations, "c_nationkey", ["n_name", "n_regionkey"]), regions, "n_regionkey", ["r_name"]).drop("n_regionkey")


_INT_TEXT = "CASE WHEN o_orderkey % 5 = 0 THEN ' ' || o_orderkey || ' ' WHEN o_orderkey % 5 = 1 THEN o_orderkey || 'x' WHEN o_orderkey % 5 = 2 THEN '' WHEN o_orderkey % 5 = 3 THEN o_orderkey || '.7' ELSE '-' || o_orderkey END"


def _int_text(o):
    k = F.col("o_orderkey").cast("string")
    m = F.col("o_orderkey") % 5
    return F.when(m == 0, F.concat(F.lit(" "), k, F.lit(" "))).when(m == 1, F.concat(k, F.lit("x"))).when(m == 2, "").when(m == 3, F.concat(k, F.lit(".7"))).otherwise(F.concat(F.lit("-"), k))


@query(f"SELECT o_orderkey, CASE WHEN regexp_full_match(trim({_INT_TEXT}), '[+-]?[0-9]{{1,19}}') THEN TRY_CAST(trim({_INT_TEXT}) AS BIGINT) END AS n FROM orders")
def cast_int(spark, d):
    return table(spark, d, "orders").select("o_orderkey", casts.to_int(_int_text(None)).alias("n"))


_DBL = "CASE WHEN l_linenumber = 1 THEN CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) || 'd' WHEN l_linenumber = 2 THEN 'NaN' WHEN l_linenumber = 3 THEN '1.2.3' ELSE ' ' || CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) END"


@query(f"SELECT l_orderkey, l_linenumber, CASE WHEN regexp_full_match(trim({_DBL}), '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim({_DBL}) AS DOUBLE) END AS x FROM lineitem")
def cast_double(spark, d):
    n, p = F.col("l_linenumber"), text2("l_extendedprice")
    dirty = F.when(n == 1, F.concat(p, F.lit("d"))).when(n == 2, "NaN").when(n == 3, "1.2.3").otherwise(F.concat(F.lit(" "), p))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", casts.to_double(dirty).alias("x"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(CAST(l_discount * 100 AS DECIMAL(14,2)) AS DOUBLE) END AS percent FROM lineitem""")
def cast_double_fr(spark, d):
    li = table(spark, d, "lineitem").withColumn("p", (F.col("l_discount") * 100).cast("decimal(14,2)").cast("string"))
    dirty = F.when(F.col("l_linenumber") == 1, "-").otherwise(F.concat(F.replace("p", F.lit("."), F.lit(",")), F.lit("%")))
    return li.select("l_orderkey", "l_linenumber", casts.to_double_fr(dirty).alias("percent"))


@query("SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(14,2)) * 100) AS BIGINT) AS cents, CAST(NULL AS BIGINT) AS nothing FROM orders")
def cast_int_fr(spark, d):
    return table(spark, d, "orders").select("o_orderkey", casts.to_int_fr(F.concat(french("o_totalprice"), F.lit(" DH"))).alias("cents"), casts.to_int_fr(F.lit("n/a")).alias("nothing"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def cast_date_fr(spark, d):
    dirty = F.when(F.col("o_orderkey") % 9 == 0, "31/02/2026").otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "d/M/yyyy")))
    return table(spark, d, "orders").select("o_orderkey", casts.to_date_fr(dirty).alias("day"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS month FROM orders""")
def cast_period(spark, d):
    dirty = F.when(F.col("o_orderkey") % 9 == 0, "13-2026").otherwise(F.date_format("o_orderdate", "MM-yyyy"))
    return table(spark, d, "orders").select("o_orderkey", casts.to_date_period(dirty).alias("month"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2) THEN NULL ELSE CAST(CAST(l_tax AS DECIMAL(14,2)) AS DECIMAL(38,6)) END AS tax,
CASE WHEN l_linenumber = 3 THEN 1 ELSE CAST(l_quantity AS INT) END AS unit FROM lineitem""")
def placeholder_null(spark, d):
    n = F.col("l_linenumber")
    dirty = F.when(n == 1, "-").when(n == 2, " ").otherwise(french("l_tax"))
    unit = F.when(n == 3, "none").otherwise(F.concat(F.lit("x "), F.col("l_quantity").cast("int").cast("string")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", casts.placeholder_decimal(dirty).alias("tax"), casts.unit_or_one(unit).alias("unit"))


@query("""WITH p AS (SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(14,2)) AS VARCHAR) AS v FROM part)
SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN CAST(p_partkey AS BIGINT) END AS i, CASE p_partkey % 4 WHEN 0 THEN CAST(v AS DOUBLE) WHEN 2 THEN CAST(v AS DOUBLE) END AS x,
CASE p_partkey % 4 WHEN 3 THEN 'no' || p_partkey END AS s FROM p""")
def number_normalise(spark, d):
    m, k = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    dirty = F.when(m == 0, F.concat(french("p_retailprice"), F.lit(" %"))).when(m == 1, F.concat(F.lit('"'), k, F.lit('"'))).when(m == 2, french("p_retailprice")).otherwise(F.concat(F.lit("no "), k))
    n = casts.normalize_number(dirty)
    return table(spark, d, "part").select("p_partkey", n["i"].alias("i"), n["d"].alias("x"), n["s"].alias("s"))


@query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS price, CAST(o_custkey AS BIGINT) AS customer, 'office_' || o_custkey AS slug, lower(o_orderpriority) AS header FROM orders""")
def wide_forms(spark, d):
    """Full-width digits and letters, odd blanks and ligatures count as what they stand for."""
    wide = lambda x: F.translate(x, "0123456789.-ABCDEFGHILMNOPRSTUVW", "".join(chr(ord(c) + 0xFEE0) for c in "0123456789.-ABCDEFGHILMNOPRSTUVW"))
    price, customer = wide(text2("o_totalprice")), F.concat(F.lit("\u2003"), wide(F.col("o_custkey").cast("string")))
    return table(spark, d, "orders").select("o_orderkey", casts.normalize_number(price)["d"].alias("price"), casts.normalize_number(customer)["i"].alias("customer"), text.slug(F.concat(F.lit("o\ufb03ce "), customer)).alias("slug"), text.fold_header(wide(F.col("o_orderpriority"))).alias("header"))


_FOLD = r"trim(regexp_replace(replace(regexp_replace(strip_accents(lower(trim({0}))), '[^\x00-\x7F]', '', 'g'), '-', ' '), '[\s]+', ' ', 'g'))"


@query(f"SELECT doc_id, md5({_FOLD.format('text')}) AS folded FROM documents")
def name_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.normalize_name(F.col("text")).cast("binary")).alias("folded"))


@query(r"""SELECT doc_id, md5(lower(trim(regexp_replace(replace(strip_accents(text), '’', ''''), '[\s]+', ' ', 'g')))) AS header FROM documents""")
def accent_strip(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.fold_header(F.col("text")).cast("binary")).alias("header"))


@query(r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}\s+,.''/#-]', '', 'g'), '[\s]+', ' ', 'g'))) AS address FROM documents""")
def address_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(text.clean_address(F.col("text")).cast("binary")).alias("address"))


_LABEL = "CASE p_partkey % 6 WHEN 0 THEN 'Rayon' WHEN 1 THEN 'Localité' WHEN 2 THEN '%' WHEN 3 THEN 'Ménages' WHEN 4 THEN 'Crédits (%)' ELSE p_type END"


@query(f"""WITH s AS (SELECT p_partkey, trim(regexp_replace(replace(strip_accents(lower(trim({_LABEL}))), '%', ' percent '), '[^a-z0-9]+', '_', 'g'), '_') AS s FROM part)
SELECT p_partkey, CASE WHEN s = '' THEN 'column' WHEN s = 'rayon' THEN 'rayon_action' WHEN s = 'localite' THEN 'localite' WHEN s = 'percent' THEN 'percent' WHEN s = 'menages' THEN 'credit_menages' ELSE s END AS field FROM s""")
def header_canonical(spark, d):
    m = F.col("p_partkey") % 6
    label = F.when(m == 0, "Rayon").when(m == 1, "Localité").when(m == 2, "%").when(m == 3, "Ménages").when(m == 4, "Crédits (%)").otherwise(F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", text.field_name(label).alias("field"))


@query(r"""WITH t AS (SELECT o_orderkey, 'Report ' || CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%m/%Y') WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y') ELSE 'undated' END AS t, strftime(o_orderdate, '%m-%Y') AS m, strftime(o_orderdate, '%Y') AS y FROM orders)
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN m WHEN 1 THEN y END AS period FROM t""")
def period_from_title(spark, d):
    k = F.col("o_orderkey") % 3
    title = F.concat(F.lit("Report "), F.when(k == 0, F.date_format("o_orderdate", "MM/yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy")).otherwise("undated"))
    return table(spark, d, "orders").select("o_orderkey", text.period_from_title(title).alias("period"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '1' ELSE CAST(p_size AS VARCHAR) || '00' END AS quantity, p_brand AS label,
CASE WHEN p_partkey % 3 = 0 THEN 'EUR' ELSE upper(lower(p_brand)[1:8]) END AS code FROM part""")
def quantity_label(spark, d):
    label = F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" 00  "), F.col("p_brand")))
    link = F.when(F.col("p_partkey") % 3 == 0, "https://bank.example/graph/currency/eur").otherwise("https://bank.example/about")
    return table(spark, d, "part").select("p_partkey", text.quantity(label).alias("quantity"), text.quantity_label(label).alias("label"), text.code_from_link(link, F.col("p_brand")).alias("code"))


_REASON = "CASE WHEN o_totalprice IS NULL OR o_totalprice < 1000 THEN 'price too low' WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'priority not allowed' WHEN o_orderstatus = 'P' THEN 'pending' END"


def _rules():
    return [("price too low", F.col("o_totalprice") >= 1000), ("priority not allowed", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")), ("pending", F.col("o_orderstatus") != "P")]


def _tagged(spark, d):
    return quarantine.tag_rejects(table(spark, d, "orders"), _rules())


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE {_REASON} IS NULL")
def split_valid(spark, d):
    return _tagged(spark, d).where("reject_reason IS NULL").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(f"SELECT * FROM (SELECT o_orderkey, o_totalprice, {_REASON} AS reject_reason FROM orders) WHERE reject_reason IS NOT NULL")
def split_rejects(spark, d):
    return _tagged(spark, d).where("reject_reason IS NOT NULL").select("o_orderkey", "o_totalprice", "reject_reason")


@query(f"WITH r AS (SELECT {_REASON} AS r FROM orders) SELECT count(*) FILTER (r IS NULL) AS n_valid, count(r) AS n_rejects, CAST(round(count(r) * 100 / count(*), 4) AS DOUBLE) AS reject_percent FROM r")
def reject_rate(spark, d):
    return quarantine.reject_rate(_tagged(spark, d))


@query("SELECT n_nationkey, n_name FROM nation WHERE lower(n_name) NOT IN ('nation_3', 'france', 'germany')")
def scope_exclude(spark, d):
    flagged = table(spark, d, "nation").withColumn("excluded", F.lower("n_name").isin("nation_3", "france", "germany"))
    return flagged.where(~F.col("excluded")).select("n_nationkey", "n_name")


@query("SELECT event_id, CAST(event_id % 50 AS VARCHAR) AS code, CAST(user_id AS VARCHAR) AS valeur, p_name AS nom FROM events JOIN part ON p_partkey = event_id % 50 WHERE user_id % 3 <> 0")
def empty_cells_dropped(spark, d):
    """The rows that consolidation keeps; empty cells and cells without a zone go."""
    cells = table(spark, d, "events").select("event_id", (F.col("event_id") % 50).cast("string").alias("code"), F.when(F.col("user_id") % 3 == 0, "  ").otherwise(F.col("user_id").cast("string")).alias("valeur"))
    zones = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("nom"))
    return census.consolidate(cells, zones)[0].select("event_id", "code", "valeur", "nom")


@query("SELECT event_id, event_type FROM events WHERE event_id % 4 <> 0 AND trim(event_type) <> ''")
def key_present(spark, d):
    e = table(spark, d, "events").withColumn("k", F.when(F.col("event_id") % 4 == 0, " ").otherwise(F.col("event_type")))
    return e.where(quarantine.key_present("k")).select("event_id", "event_type")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y FROM orders WHERE o_orderkey % 5 <> 0")
def shape_filter(spark, d):
    o = table(spark, d, "orders").withColumn("y", F.when(F.col("o_orderkey") % 5 == 0, "n.a.").otherwise(F.date_format("o_orderdate", "yyyy")))
    return o.where(F.col("y").rlike("^[0-9]{4}$")).select("o_orderkey", F.col("y").cast("int").alias("y"))


@query("SELECT event_id, user_id FROM events WHERE event_type IN ('click', 'purchase')")
def subset(spark, d):
    return table(spark, d, "events").where(F.col("event_type").isin("click", "purchase")).select("event_id", "user_id")


@query("SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN 'C-' || s_suppkey END, CASE WHEN s_suppkey % 3 = 1 THEN 'P-' || s_nationkey END, 'R') AS code FROM supplier WHERE s_nationkey < 20")
def level_filter(spark, d):
    k = F.col("s_suppkey") % 3
    commune = F.when(k == 0, F.concat(F.lit("C-"), F.col("s_suppkey").cast("string"))).otherwise(" ")
    province = F.when(k == 1, F.concat(F.lit("P-"), F.col("s_nationkey").cast("string"))).otherwise("")
    return table(spark, d, "supplier").where("s_nationkey < 20").select("s_suppkey", text.deepest_code(commune, province, F.lit("R")).alias("code"))


@query("SELECT page_id, url FROM pages WHERE lower(url) LIKE '%casino%' OR lower(url) LIKE '%bets%' OR lower(url) LIKE '%.html'")
def keyword_filter(spark, d):
    words = F.array(F.lit("casino"), F.lit("bets"))
    return table(spark, d, "pages").where(F.exists(words, lambda w: F.contains(F.lower("url"), w)) | F.lower("url").endswith(".html")).select("page_id", "url")


@query("SELECT n_nationkey, CAST(n_name ILIKE '%AN%' AS BOOLEAN) AS has_an, starts_with(lower(n_name), lower(r_name)[1:1]) AS same_letter FROM nation JOIN region ON n_regionkey = r_regionkey")
def case_insensitive_match(spark, d):
    j = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select("n_nationkey", F.col("n_name").ilike("%AN%").alias("has_an"), F.startswith(F.lower("n_name"), F.substring(F.lower("r_name"), 1, 1)).alias("same_letter"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def text_dates(spark, d):
    return table(spark, d, "orders").select("o_orderkey", casts.to_date_fr(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day"))


@query("""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS k, len(string_split(event_type || '|x', '|')) AS n_types FROM events""")
def tags_map(spark, d):
    props = F.when(F.col("event_id") % 10 == 0, " ").otherwise(F.col("props"))
    types = text.split_types(F.concat(F.col("event_type"), F.lit("|x")))
    return table(spark, d, "events").select("event_id", F.try_element_at(text.to_tags(props), F.lit("k")).alias("k"), F.size(types).cast("bigint").alias("n_types"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'shop' WHEN event_id % 3 = 1 THEN 'office' END AS category, CASE WHEN event_id % 3 < 2 THEN event_type END AS val FROM events""")
def pick_category(spark, d):
    m = F.col("event_id") % 3
    tags = F.when(m == 0, F.create_map(F.lit("office"), F.lit("x"), F.lit("shop"), F.col("event_type"))).when(m == 1, F.create_map(F.lit("office"), F.col("event_type"))).otherwise(F.create_map(F.lit("name"), F.lit("y")))
    c = text.pick_category(tags)
    return table(spark, d, "events").select("event_id", c["key"].alias("category"), c["value"].alias("val"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS rayon_action, event_type AS localite FROM events""")
def map_normalise(spark, d):
    """Two labels of one canonical name: the last counts."""
    raw = F.map_from_arrays(F.array(F.lit("Ville"), F.lit("Rayon"), F.lit("Commune")), F.array(F.lit("?"), F.get_json_object("props", "$.k"), F.col("event_type")))
    dealt = table(spark, d, "events").repartition("event_id")  # a small file may hold many rows
    named = dealt.select("event_id", text.normalize_map(raw).alias("m"))
    return named.select("event_id", F.try_element_at("m", F.lit("rayon_action"))["i"].alias("rayon_action"), F.try_element_at("m", F.lit("localite"))["s"].alias("localite"))


@query("""SELECT p_partkey, concat_ws('|', p_partkey, p_brand, p_type) AS k, CASE WHEN regexp_matches(trim(regexp_replace(p_name, '[^A-Za-z0-9_]', '_', 'g'), '_'), '^[0-9]') THEN 't_' ELSE '' END || trim(regexp_replace(p_name, '[^A-Za-z0-9_]', '_', 'g'), '_') AS ident FROM part""")
def safe_identifiers(spark, d):
    return table(spark, d, "part").select("p_partkey", F.concat_ws("|", F.col("p_partkey").cast("string"), "p_brand", "p_type").alias("k"), text.identifier(F.col("p_name")).alias("ident"))


@query("SELECT event_id, CAST(1500 + event_id % 7 AS BIGINT) AS ms, sha256(props) AS sha, CAST(strlen(props) AS INT) AS size FROM events")
def query_keys(spark, d):
    e = table(spark, d, "events").withColumn("t2", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + 1_500_000 + (F.col("event_id") % 7) * 1000 + 999))
    return e.select("event_id", text.duration_ms(F.col("ts"), F.col("t2")).alias("ms"), F.sha2("props", 256).alias("sha"), F.octet_length("props").alias("size"))
