"""Scalar functions over texts rendered from the standard tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import checks, dates, ids, makes, money
from tallyloom.functions import text as T
from tallyloom.operators import canonical
from tallyloom.plans import query
from tallyloom.sources.tables import table

PRICE_SQL = """
prices AS (
  SELECT l_orderkey, l_linenumber, floor(l_extendedprice)::BIGINT AS n, l_quantity AS q, (l_orderkey + l_linenumber) % 9 AS form FROM lineitem
), rendered AS (
  SELECT *, CASE form WHEN 0 THEN 'QTY-' || n WHEN 1 THEN n || '/-' WHEN 2 THEN '$' || n WHEN 3 THEN 'SAR ' || n || '.50'
    WHEN 4 THEN (n // 1000) || ',' || lpad((n % 1000)::VARCHAR, 3, '0') WHEN 5 THEN 'To be Quoted' WHEN 6 THEN 'Included Above' WHEN 7 THEN (n % 100) || ' Lakhs' ELSE 'Not Quoted' END AS price_text
  FROM prices)"""


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.floor("l_extendedprice").cast("long")
    t = n.cast("string")
    form = (F.col("l_orderkey") + F.col("l_linenumber")) % 9
    texts = [F.concat(F.lit("QTY-"), t), F.concat(t, F.lit("/-")), F.concat(F.lit("$"), t), F.concat(F.lit("SAR "), t, F.lit(".50"))]
    texts.append(F.concat(F.floor(n / 1000).cast("string"), F.lit(","), F.lpad((n % 1000).cast("string"), 3, "0")))
    texts += [F.lit("To be Quoted"), F.lit("Included Above"), F.concat((n % 100).cast("string"), F.lit(" Lakhs"))]
    chosen = F.when(form == 0, texts[0])
    for i, x in enumerate(texts[1:], 1):
        chosen = chosen.when(form == i, x)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", n.alias("n"), F.col("l_quantity").alias("q"), form.alias("form"), chosen.otherwise("Not Quoted").alias("price_text"))


@query(f"""WITH {PRICE_SQL}
SELECT l_orderkey, l_linenumber, price_text, CASE form WHEN 1 THEN n::DOUBLE WHEN 2 THEN n::DOUBLE WHEN 3 THEN n + 0.5::DOUBLE WHEN 4 THEN n::DOUBLE WHEN 7 THEN (n % 100) * 100000.0::DOUBLE END AS value,
  CASE form WHEN 1 THEN 'INR' WHEN 2 THEN 'USD' WHEN 3 THEN 'SAR' WHEN 4 THEN 'INR' WHEN 7 THEN 'INR' END AS currency FROM rendered""")
def q_price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = money.parse_price(F.col("price_text"))
    return _rendered(spark, sf_dir).select("l_orderkey", "l_linenumber", "price_text", p["value"].alias("value"), p["currency"].alias("currency"))


@query(f"""WITH {PRICE_SQL}
SELECT status, is_placeholder, count(*) AS n FROM (
  SELECT CASE WHEN form = 5 THEN 'QUOTED' WHEN form = 6 THEN 'INCLUDED' WHEN form IN (0, 8) THEN 'MISSING' ELSE 'NUMERIC' END AS status, form IN (5, 6, 8) AS is_placeholder FROM rendered) GROUP BY ALL""")
def q_price_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = money.parse_price(F.col("price_text"))
    return _rendered(spark, sf_dir).groupBy(p["status"].alias("status"), p["is_placeholder"].alias("is_placeholder")).agg(F.count("*").alias("n"))


@query("""
SELECT l_orderkey, l_linenumber, text, (l_quantity::BIGINT)::DOUBLE * CASE WHEN l_linenumber % 2 = 0 THEN 100000 ELSE 10000000 END AS value FROM (
  SELECT *, (l_quantity::BIGINT) || CASE WHEN l_linenumber % 2 = 0 THEN ' lakh' ELSE ' Cr.' END AS text FROM lineitem)""")
def q_lakh_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("l_quantity").cast("long").cast("string"), F.when(F.col("l_linenumber") % 2 == 0, " lakh").otherwise(" Cr."))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"), money.parse_price(text)["value"].alias("value"))


UNITS = ["Nos.", "Set", "Meters", "", "Furlong", "Sq.m", "hrs"]
UNITS_SQL = "['Nos.', 'Set', 'Meters', '', 'Furlong', 'Sq.m', 'hrs'][(l_linenumber % 7 + 1)::INT]"


def _unit() -> Column:
    return F.element_at(F.array(*map(F.lit, UNITS)), (F.col("l_linenumber") % 7 + 1).cast("int"))


@query(f"""
WITH t AS (SELECT l_orderkey, l_linenumber, {UNITS_SQL} AS u, (l_quantity::BIGINT)::VARCHAR AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN u IN ('', 'Furlong') THEN NULL ELSE q::DOUBLE END AS value, CASE WHEN u IN ('', 'Furlong') THEN NULL ELSE u END AS unit FROM t""")
def q_quantity_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = money.parse_quantity(F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit(" "), _unit()))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", q["value"].alias("value"), q["unit"].alias("unit"))


@query(f"""
SELECT u AS unit_text, CASE u WHEN 'Nos.' THEN 'NOS' WHEN 'Set' THEN 'SET' WHEN 'Meters' THEN 'METER' WHEN 'Furlong' THEN 'FURLONG' WHEN 'Sq.m' THEN 'SQM' WHEN 'hrs' THEN 'HOUR' ELSE '' END AS unit,
  CASE u WHEN 'Nos.' THEN 'COUNT' WHEN 'Set' THEN 'BUNDLE' WHEN 'Meters' THEN 'LENGTH' WHEN 'Sq.m' THEN 'AREA' WHEN 'hrs' THEN 'TIME' ELSE '' END AS unit_class, count(*) AS n
FROM (SELECT {UNITS_SQL} AS u FROM lineitem) GROUP BY ALL""")
def q_unit_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = money.normalize_unit(F.col("unit_text"))
    return table(spark, sf_dir, "lineitem").select(_unit().alias("unit_text")).groupBy("unit_text").agg(F.count("*").alias("n")).select("unit_text", unit.alias("unit"), money.unit_class(unit).alias("unit_class"), "n")


@query(f"""WITH {PRICE_SQL}
SELECT l_orderkey, l_linenumber, try_cast(replace(regexp_replace(regexp_replace(price_text, '/-\\s*$', ''), '[^0-9,.\\-]', '', 'g'), ',', '') AS DOUBLE) AS permissive,
  try_cast(replace(regexp_extract(price_text, '[-+]?\\d[\\d,]*(?:\\.\\d+)?'), ',', '') AS DOUBLE) AS first_number FROM rendered""")
def q_v1_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("price_text")
    return _rendered(spark, sf_dir).select("l_orderkey", "l_linenumber", money.permissive_number(c).alias("permissive"), money.first_number(c).alias("first_number"))


HOLES_SQL = """
holes AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS q, CASE WHEN l_orderkey % 3 <> 0 THEN l_extendedprice / l_quantity END AS u,
    CASE WHEN (l_orderkey + l_linenumber) % 4 <> 0 THEN CASE WHEN l_orderkey % 7 = 0 THEN l_extendedprice * 2 ELSE l_extendedprice END END AS t FROM lineitem
), solved AS (
  SELECT *, CASE WHEN u IS NULL AND t IS NOT NULL AND q > 0 THEN t / q ELSE u END AS unit, CASE WHEN t IS NULL AND u IS NOT NULL AND q > 0 THEN u * q ELSE t END AS total,
    CASE WHEN u IS NULL AND t IS NULL THEN 'NONE' WHEN t IS NULL AND u IS NOT NULL AND q > 0 THEN 'DERIVED_FROM_UNIT' WHEN u IS NULL AND q > 0 THEN 'DERIVED_FROM_TOTAL' ELSE 'REPORTED' END AS basis FROM holes)"""


def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        k, n, F.when(k % 5 != 0, F.col("l_quantity")).alias("q"), F.when(k % 3 != 0, F.col("l_extendedprice") / F.col("l_quantity")).alias("u"),
        F.when((k + n) % 4 != 0, F.when(k % 7 == 0, F.col("l_extendedprice") * 2).otherwise(F.col("l_extendedprice"))).alias("t"),
    )


@query(f"WITH {HOLES_SQL} SELECT l_orderkey, l_linenumber, unit, total, basis FROM solved")
def q_resolve_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = money.resolve_prices(F.col("u"), F.col("t"), F.col("q"))
    return _holes(spark, sf_dir).select("l_orderkey", "l_linenumber", r["unit"].alias("unit"), r["total"].alias("total"), r["basis"].alias("basis"))


@query(f"""WITH {HOLES_SQL}
SELECT price_quality, count(*) AS n FROM (SELECT CASE WHEN l_orderkey % 7 = 0 THEN 'FLAGGED' WHEN basis = 'NONE' THEN CASE WHEN l_linenumber = 1 THEN 'NON_NUMERIC' ELSE 'NO_PRICE' END ELSE 'TRUSTED' END AS price_quality FROM solved) GROUP BY ALL""")
def q_price_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    basis = money.resolve_prices(F.col("u"), F.col("t"), F.col("q"))["basis"]
    status = F.when(F.col("l_linenumber") == 1, "QUOTED_SEPARATELY").otherwise("MISSING")
    errors = F.when(F.col("l_orderkey") % 7 == 0, "PRICE_ARITHMETIC_MISMATCH").otherwise("")
    return _holes(spark, sf_dir).groupBy(money.price_quality(basis, status, errors).alias("price_quality")).agg(F.count("*").alias("n"))


@query(f"""WITH {HOLES_SQL}
SELECT l_orderkey, l_linenumber, CASE WHEN q IS NULL OR u IS NULL OR t IS NULL THEN '' WHEN abs(q * u - t) <= greatest(1.0, 0.02 * t) THEN 'OK' ELSE 'MISMATCH' END AS arithmetic FROM holes""")
def q_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _holes(spark, sf_dir).select("l_orderkey", "l_linenumber", money.arithmetic_check(F.col("q"), F.col("u"), F.col("t")).alias("arithmetic"))


DATE_SQL = """
dated AS (
  SELECT o_orderkey, (o_orderdate + INTERVAL 25 YEAR)::DATE AS d, o_orderkey % 5 AS form FROM orders
), printed AS (
  SELECT *, CASE form WHEN 0 THEN strftime(d, '%d.%m.%Y') WHEN 1 THEN strftime(d, '%Y/%m/%d') WHEN 2 THEN strftime(d, '%d %B %y') WHEN 3 THEN strftime(d, '%m/%d/%Y') ELSE '31.02.' || strftime(d, '%Y') END AS text FROM dated
), parsed AS (
  SELECT *, year(d) BETWEEN 2015 AND 2027 AS inside,
    CASE WHEN form = 4 OR NOT year(d) BETWEEN 2015 AND 2027 THEN '' WHEN form = 3 AND day(d) <= 12 THEN strftime(d, '%Y-%d-%m') ELSE strftime(d, '%Y-%m-%d') END AS date,
    form IN (0, 3) AND day(d) <= 12 AND year(d) BETWEEN 2015 AND 2027 AS ambiguous FROM printed)"""


def _printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.add_months(F.to_date("o_orderdate"), 300)
    form = F.col("o_orderkey") % 5
    text = F.when(form == 0, F.date_format(d, "dd.MM.yyyy")).when(form == 1, F.date_format(d, "yyyy/MM/dd")).when(form == 2, F.date_format(d, "dd MMMM yy")).when(form == 3, F.date_format(d, "MM/dd/yyyy")).otherwise(F.concat(F.lit("31.02."), F.date_format(d, "yyyy")))
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("d"), form.alias("form"), text.alias("text"))


@query(f"WITH {DATE_SQL} SELECT o_orderkey, text, date, ambiguous FROM parsed")
def q_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = dates.parse_document_date(F.col("text"))
    return _printed(spark, sf_dir).select("o_orderkey", "text", p["date"].alias("date"), p["ambiguous"].alias("ambiguous"))


@query(f"""WITH {DATE_SQL}
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND inside THEN strftime(d, '%Y-%m-%d') ELSE date END AS date,
  CASE WHEN o_orderkey % 2 = 0 AND inside THEN 'ERP_ORDER' WHEN date <> '' THEN 'PARSED_DOC' ELSE 'NONE' END AS source,
  NOT (o_orderkey % 2 = 0 AND inside) AND ambiguous AS ambiguous FROM parsed""")
def q_date_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(" 09:12:31")))
    r = dates.resolve_date(export, F.col("text"))
    return _printed(spark, sf_dir).select("o_orderkey", r["date"].alias("date"), r["source"].alias("source"), r["ambiguous"].alias("ambiguous"))


@query(f"WITH {DATE_SQL} SELECT substr(date, 1, 4) AS year, substr(date, 1, 7) AS month, count(*) AS n FROM parsed GROUP BY ALL")
def q_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = dates.resolve_date(F.lit(None).cast("string"), F.col("text"))
    return _printed(spark, sf_dir).groupBy(r["year"].alias("year"), r["month"].alias("month")).agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, trim(regexp_replace(regexp_replace(replace(lower(p_name || ' & ' || p_brand || ' (' || p_type || ') *'), '&', 'and'), '[^a-z0-9\\s./()-]', ' ', 'g'), '\\s+', ' ', 'g')) AS label,
  trim(regexp_replace(replace(regexp_replace(trim(regexp_replace(regexp_replace(replace(lower('SR. NO. (' || p_brand || ')'), '&', 'and'), '[^a-z0-9\\s./()-]', ' ', 'g'), '\\s+', ' ', 'g')), '[(\\[][^)\\]]*[)\\]]', ' ', 'g'), '.', ' '), '\\s+', ' ', 'g')) AS header FROM part""")
def q_normalize_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("p_name"), F.lit(" & "), F.col("p_brand"), F.lit(" ("), F.col("p_type"), F.lit(") *"))
    return table(spark, sf_dir, "part").select("p_partkey", T.normalize_label(text).alias("label"), T.normalize_header_cell(F.concat(F.lit("SR. NO. ("), F.col("p_brand"), F.lit(")"))).alias("header"))


@query("SELECT p_partkey, regexp_replace(upper(p_brand || '-' || p_name), '[^A-Z0-9]', '', 'g') AS key FROM part")
def q_collapse_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.collapse_key(F.concat("p_brand", F.lit("-"), "p_name")).alias("key"))


@query("""SELECT c_custkey, upper(trim(regexp_replace(c_name || '  ' || c_mktsegment, '\\s+', ' ', 'g'))) AS value,
  trim(regexp_replace('x' || chr(9) || c_name || chr(10) || ' y ', '\\s+', ' ', 'g')) AS spaced FROM customer""")
def q_text_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit(" -("), "c_name", F.lit("  "), "c_mktsegment", F.lit(").;"))
    spaced = F.concat(F.lit("x\t"), "c_name", F.lit("\n y "))
    return table(spark, sf_dir, "customer").select("c_custkey", T.normalize_text_value(text).alias("value"), T.normalize_spaces(spaced).alias("spaced"))


def _makes(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand = F.upper(F.replace("p_brand", F.lit("#"), F.lit(" ")))
    k = F.col("p_partkey") % 5
    text = F.when(k == 0, F.concat(brand, F.lit(" AG, GERMANY"))).when(k == 1, brand).when(k == 2, F.concat(brand, F.lit("/EMERSON OR EQUIVALENT"))).when(k == 3, F.concat(F.replace(brand, F.lit(" "), F.lit("")), F.lit(" GMBH"))).otherwise("ANY APPROVED MAKE")
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("make"))


MAKES_SQL = """
brands AS (SELECT p_partkey, p_partkey % 5 AS k, upper(replace(p_brand, '#', ' ')) AS b FROM part
), parts AS (SELECT p_partkey, k, b, CASE k WHEN 0 THEN [b] WHEN 1 THEN [b] WHEN 2 THEN [b, 'EMERSON'] WHEN 3 THEN [replace(b, ' ', '')] ELSE [] END AS makes FROM brands)"""


@query(f"WITH {MAKES_SQL} SELECT p_partkey, list_aggregate(list_transform(makes, lambda x: x), 'string_agg', '|') AS makes FROM parts WHERE k < 4 UNION ALL SELECT p_partkey, '' FROM parts WHERE k = 4")
def q_make_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _makes(spark, sf_dir).select("p_partkey", F.array_join(makes.make_parts(F.col("make")), "|").alias("makes"))


@query(f"""WITH {MAKES_SQL}, flat AS (SELECT p_partkey, k, b, unnest(makes) AS part FROM parts
), counts AS (SELECT part, replace(part, ' ', '') AS key, count(*) AS n FROM flat GROUP BY ALL
), shown AS (SELECT key, arg_min(part, (-n, part)) AS display FROM counts GROUP BY key
), told AS (SELECT p_partkey, k, b, CASE WHEN part = 'EMERSON' THEN 'EMERSON ELECTRIC' ELSE display END AS final, part = 'EMERSON' AS alias FROM flat JOIN shown ON replace(part, ' ', '') = key
), joined AS (SELECT p_partkey, any_value(k) AS k, any_value(b) AS b, string_agg(DISTINCT final, '|' ORDER BY final) AS canonical, bool_or(alias) AS by_alias FROM told GROUP BY p_partkey)
SELECT p_partkey, canonical, CASE WHEN by_alias THEN 'ALIAS' WHEN k = 1 AND canonical = b THEN 'COSMETIC' ELSE 'RULE' END AS basis FROM joined""")
def q_make_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    alias = spark.createDataFrame([("emerson", "EMERSON ELECTRIC")], "alias string, canonical string")
    return canonical.canonical_makes(_makes(spark, sf_dir), "p_partkey", "make", alias)


@query("""WITH m AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN replace(upper(p_name), ' ', '') ELSE upper(p_name) END AS model FROM part
), c AS (SELECT model, regexp_replace(model, '[^A-Z0-9]', '', 'g') AS key, count(*) AS n FROM m GROUP BY ALL)
SELECT key, arg_min(model, (-n, model)) AS display, sum(n)::BIGINT AS n_rows FROM c GROUP BY key""")
def q_model_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = F.when(F.col("p_partkey") % 3 == 0, F.replace(F.upper("p_name"), F.lit(" "), F.lit(""))).otherwise(F.upper("p_name"))
    return canonical.display_spellings(table(spark, sf_dir, "part").select(model.alias("model")), "model")


MODEL_RULES = [("BLUE", "BLUE LINE"), ("BLUE GEAR", "NEVER REACHED"), ("RED", "RED LINE")]
DESCRIPTION_RULES = [("gear|bolt", "MECHANICAL"), ("(", "BROKEN"), (r"\bvalve\b", "VALVES")]


@query("""SELECT p_partkey, CASE WHEN starts_with(upper(p_name), 'BLUE') THEN 'BLUE LINE' WHEN starts_with(upper(p_name), 'RED') THEN 'RED LINE' WHEN regexp_matches(p_name, '(?i)gear|bolt') THEN 'MECHANICAL' WHEN regexp_matches(p_name, '(?i)\\bvalve\\b') THEN 'VALVES' ELSE '' END AS family,
  CASE WHEN starts_with(upper(p_name), 'BLUE') OR starts_with(upper(p_name), 'RED') THEN 'MODEL_RULE' WHEN regexp_matches(p_name, '(?i)gear|bolt|\\bvalve\\b') THEN 'DESCRIPTION_RULE' ELSE '' END AS basis FROM part""")
def q_product_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = canonical.product_family(F.col("p_name"), F.col("p_name"), MODEL_RULES, DESCRIPTION_RULES)
    return table(spark, sf_dir, "part").select("p_partkey", r["family"].alias("family"), r["basis"].alias("basis"))


@query("""
WITH t AS (SELECT o_orderkey, ['EMAIL', 'Q24W' || o_orderkey, 'R1', 'AB1', 'TENDER'][(o_orderkey % 5 + 1)::INT] AS n, CASE WHEN o_orderkey % 3 = 0 THEN 'f' || o_orderkey || '.txt' ELSE '' END AS f FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 1 AND length(n) >= 6 THEN n WHEN f <> '' THEN 'DOC::' || f ELSE 'ORDER::' || o_orderkey END AS key,
  CASE WHEN o_orderkey % 5 = 1 AND length(n) >= 6 THEN 'QUOTATION_NUMBER' WHEN f <> '' THEN 'DOCUMENT_FALLBACK' ELSE 'ORDER_FALLBACK' END AS basis FROM t""")
def q_quotation_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    n = F.element_at(F.array(F.lit(" Email"), F.concat(F.lit("q24 w"), k.cast("string")), F.lit("R1"), F.lit("ab1"), F.lit("Tender")), (k % 5 + 1).cast("int"))
    r = ids.quotation_key(n, F.when(k % 3 == 0, F.concat(F.lit("f"), k.cast("string"), F.lit(".txt"))), k)
    return table(spark, sf_dir, "orders").select("o_orderkey", r["key"].alias("key"), r["basis"].alias("basis"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN l_orderkey || '.' || l_linenumber WHEN 1 THEN (l_orderkey % 100)::VARCHAR WHEN 2 THEN '' ELSE '' END AS parent,
  CASE l_linenumber % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS level FROM lineitem""")
def q_item_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    text = F.when(n % 4 == 0, F.concat(k, F.lit("."), n.cast("string"), F.lit(".7)"))).when(n % 4 == 1, F.concat((F.col("l_orderkey") % 100).cast("string"), F.lit(" b"))).when(n % 4 == 2, F.concat(k, F.lit(". "))).otherwise(" ")
    h = ids.item_hierarchy(text)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", h["parent"].alias("parent"), h["level"].alias("level"))


@query("SELECT p_partkey, p_name || ' ' || p_brand AS heading FROM part")
def q_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    tail = F.when(k == 0, "\nMake: X").when(k == 1, "\nWith hood").otherwise("\n• steel")
    return table(spark, sf_dir, "part").select("p_partkey", T.heading(F.concat("p_name", F.lit("\n "), "p_brand", tail, F.lit("\nmore"))).alias("heading"))


@query("""SELECT o_orderkey, ['Q24W' || o_orderkey || 'R3', 'Q24W' || o_orderkey || 'R1', 'Q99X55R2', 'Q24W' || o_orderkey, 'Q24W' || o_orderkey][(o_orderkey % 5 + 1)::INT] AS number, o_orderkey % 5 = 3 AS flagged FROM orders""")
def q_manifest_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    rfq = F.concat(F.lit("Q24W"), F.col("o_orderkey").cast("string"))
    revision = F.element_at(F.array(F.concat(rfq, F.lit("R3")), F.lit("R1"), F.lit("Q99X55R2"), F.lit("PO Booking Mail"), F.lit("")), (F.col("o_orderkey") % 5 + 1).cast("int"))
    m = ids.manifest_number(rfq, revision)
    return table(spark, sf_dir, "orders").select("o_orderkey", m["number"].alias("number"), m["flagged"].alias("flagged"))


@query("""SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_linenumber = 1 THEN 'DATE_UNPARSEABLE' END, CASE WHEN l_linenumber = 2 THEN 'DATE_MISSING' END, CASE WHEN l_linenumber = 3 THEN 'DATE_AMBIGUOUS_DAY_MONTH' END,
  CASE WHEN l_orderkey % 5 = 0 THEN 'NO_MATCHED_CUSTOMER' END, CASE WHEN l_orderkey % 4 <> 0 AND l_orderkey % 2 = 0 THEN 'LOW_CONFIDENCE_ITEM_WITH_PRICE' END, CASE WHEN l_orderkey % 4 <> 0 AND l_orderkey % 3 = 0 THEN 'PRICE_WITHOUT_DESCRIPTION' END,
  CASE WHEN l_orderkey % 4 = 0 THEN 'NO_PRICE' END, CASE WHEN l_orderkey % 4 <> 0 AND l_orderkey % 7 = 0 THEN 'IMPLAUSIBLE_NEGATIVE_PRICE' END], lambda x: x IS NOT NULL) AS reasons FROM lineitem""")
def q_review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    price = F.when(k % 4 == 0, F.lit(0.0)).when(k % 7 == 0, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    r = checks.review_reasons(F.when(n > 2, "2024-01-01"), F.when(n == 1, "soon"), n == 3, F.when(k % 5 != 0, "9"), F.lit(True), price, F.lit(None).cast("double"), F.when(k % 2 == 0, "LOW").otherwise("HIGH"), F.when(k % 3 != 0, "x"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r.alias("reasons"))


@query("""SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN l_linenumber % 3 = 0 THEN 'NOT_VERBATIM_IN_RAW_TEXT:unit_price' END, CASE WHEN l_orderkey % 5 = 0 THEN 'PRICE_ARITHMETIC_MISMATCH' END,
  CASE WHEN l_orderkey % 2 = 0 THEN 'QUANTITY_MISSING_UNIT' END, CASE WHEN l_linenumber = 7 THEN 'ITEM_NO_MALFORMED' END], lambda x: x IS NOT NULL) AS codes FROM lineitem""")
def q_validation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    total = F.when(k % 5 == 0, F.lit(9000.0)).otherwise(F.lit(4000.0))
    raw = F.concat(F.when(n % 3 == 0, "unit 1999 ").otherwise("unit 2000 "), F.when(k % 5 == 0, "9000").otherwise("4000"))
    item = F.when(n == 7, "700").otherwise(n.cast("string"))
    codes = checks.row_codes(item, F.lit(2.0), F.when(k % 2 == 1, "Nos"), F.lit(2000.0), total, F.lit("2000"), F.when(k % 5 == 0, "9000").otherwise("4000"), raw, F.lit(False))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", codes.alias("codes"))
