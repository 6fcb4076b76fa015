"""Queries of single-value functions, small windows, sources, sinks and streams over the standard tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions import checks, ids, makes, money, similarity
from tallyloom.functions import text as T
from tallyloom.operators import backfill, bank, cleaning, examples, joins, pii, ranking
from tallyloom.plans import query
from tallyloom.sources import sinks, tables
from tallyloom.sources.tables import table
from tallyloom.streaming import incremental


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder name where driver and executors can both write."""
    return f"{ranking.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 IN (1, 3, 4) THEN NULL ELSE p_retailprice * 10 END AS number,
  CASE WHEN p_partkey % 5 IN (1, 3, 4) THEN '' WHEN p_retailprice * 10 = floor(p_retailprice * 10) THEN (p_retailprice * 10)::BIGINT::VARCHAR ELSE round(p_retailprice * 10, 4)::VARCHAR END AS shown FROM part""")
def q_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, x = F.col("p_partkey") % 5, F.col("p_retailprice") * 10
    plain = F.when(x == F.floor(x), x.cast("long").cast("string")).otherwise(x.cast("string"))
    grouped = F.regexp_replace(plain, r"^(\d+)(\d{3})\b", "$1,$2")
    text = F.when(k == 0, grouped).when(k == 1, "nan").when(k == 2, F.concat(F.lit("  "), plain, F.lit("\t"))).when(k == 3, F.concat(plain, F.lit(" each"))).otherwise(" ")
    rows = table(spark, sf_dir, "part").select("p_partkey", money.to_number(text).alias("number"))
    return rows.withColumn("shown", money.format_number(F.col("number")))


_SCALED = "l_extendedprice * (CASE l_linenumber % 4 WHEN 0 THEN 0.001 WHEN 1 THEN 1 WHEN 2 THEN 10000 ELSE 1000000 END)::DOUBLE"


@query(f"""SELECT l_orderkey, l_linenumber, l_extendedprice, x BETWEEN 1e3 AND 5e8 AS unit_ok, x BETWEEN 1e3 AND 5e9 AS total_ok FROM (SELECT *, {_SCALED} AS x FROM lineitem)""")
def q_price_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_linenumber") % 4
    x = F.col("l_extendedprice") * F.when(k == 0, 0.001).when(k == 1, 1.0).when(k == 2, 10000.0).otherwise(1000000.0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", money.unit_price_ok(x).alias("unit_ok"), money.total_price_ok(x).alias("total_ok"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_suppkey, CASE WHEN l_suppkey % 4 IN (0, 3) AND l_suppkey % 3 <> 0 THEN l_quantity WHEN l_suppkey % 3 = 0 THEN l_quantity END AS value,
  CASE WHEN l_suppkey % 3 = 0 THEN 'Sets' WHEN l_suppkey % 4 = 0 THEN 'Nos' WHEN l_suppkey % 4 = 3 THEN 'Sets.' END AS unit FROM lineitem""")
def q_quantity_and_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_suppkey"), F.col("l_quantity").cast("long").cast("string")
    quantity = F.when(k % 3 == 0, F.concat(n, F.lit(" Sets"))).otherwise(n)
    unit = F.when(k % 4 == 0, "Nos").when(k % 4 == 1, "crates").when(k % 4 == 2, "").otherwise("Sets.")
    return table(spark, sf_dir, "lineitem").withColumn("q", money.quantity_and_unit(quantity, unit)).select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "q.value", "q.unit")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 11 = 0 THEN NULL WHEN l_partkey % 3 <> 0 THEN l_extendedprice WHEN l_partkey % 2 = 0 THEN l_quantity * l_discount END AS total,
  CASE WHEN l_suppkey % 11 = 0 THEN '' WHEN l_partkey % 3 <> 0 THEN 'STATED' WHEN l_partkey % 2 = 0 THEN 'DERIVED' ELSE '' END AS source FROM lineitem""")
def q_stated_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated, unit = F.when(F.col("l_partkey") % 3 != 0, F.col("l_extendedprice")), F.when(F.col("l_partkey") % 2 == 0, F.col("l_discount"))
    rows = table(spark, sf_dir, "lineitem").withColumn("t", money.stated_or_derived_total(stated, unit, F.col("l_quantity"), F.col("l_suppkey") % 11 == 0))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "t.total", "t.source")


@query("""WITH l AS (SELECT p_partkey, lower(p_name) AS name FROM part)
SELECT p_partkey, name || ' no rs and inr' AS cell, p_partkey % 3 = 0 AS labelled, upper(name) || ' : x' AS value FROM l""")
def q_cell_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    cell = F.concat(F.lit("  "), F.initcap(name), F.lit(" (each) No. Rs.\t& [INR] "))
    label = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("unit price: "), name)).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("unit prices "), name)).otherwise(name)
    value = F.concat(F.lit(" :- "), F.upper(name), F.lit("  :\t x |"))
    return table(spark, sf_dir, "part").select("p_partkey", T.normalize_header_cell(cell).alias("cell"), T.contains_label(label, ["rate", "unit price"]).alias("labelled"), T.clean_field_value(value).alias("value"))


@query("""SELECT doc_id, greatest(1, length(text) // 4)::INTEGER AS n_tokens, least(greatest(length(text) // 2 + 512, 1024), 4096)::INTEGER AS budget FROM documents""")
def q_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.estimate_tokens(F.col("text")).alias("n_tokens"), T.completion_budget(F.col("text")).alias("budget"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(9), ' '), ' {2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text FROM documents""")
def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.clean_text(F.col("text")).alias("text"))


@query("""SELECT c_custkey, 'offer ' || c_custkey || CASE WHEN c_custkey % 3 = 2 THEN ' blue harbour' ELSE '' END || chr(10) || 'end' AS text FROM customer""")
def q_without_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    mark = F.when(k % 3 == 0, "BLUE HARBOUR - WORKS 10").when(k % 3 == 1, "Blue Harbour–works   IO").otherwise("blue harbour")
    text = F.concat(F.lit("offer "), k.cast("string"), F.lit(" "), mark, F.lit(" \nend"))
    cleaned = cleaning.without_messages(text, ["Blue Harbour - Works 10", "Blue Harbour - Works 1O"])
    return table(spark, sf_dir, "customer").select("c_custkey", F.regexp_replace(cleaned, " +\n", "\n").alias("text"))


@query("""WITH n AS (SELECT c_custkey, lower('M/s. ' || c_name || ' & Sons Corp. Pvt. Ltd.') AS s, (c_custkey % 101) / 100.0 AS score FROM customer)
SELECT c_custkey, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(s, 'm/s\\.?', ' '), 'pvt.', 'private'), 'pvt', 'private'), 'ltd.', 'limited'), 'ltd', 'limited'), 'co.', 'company'), 'corp.', 'corporation'), 'corp', 'corporation'), '&', 'and'), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS name,
  CASE WHEN score >= 1 THEN 'EXACT' WHEN score >= 0.9 THEN 'HIGH' WHEN score >= 0.75 THEN 'REVIEW' WHEN score >= 0.5 THEN 'LOW' ELSE 'NO_MATCH' END AS band FROM n""".replace("\\\\", "\\"))
def q_name_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("M/s. "), F.col("c_name"), F.lit(" & Sons Corp. Pvt. Ltd."))
    return table(spark, sf_dir, "customer").select("c_custkey", similarity.normalize_name(name).alias("name"), similarity.band((F.col("c_custkey") % 101) / 100).alias("band"))


@query("""WITH n AS (SELECT p_partkey, upper(split_part(p_name, ' ', 1)) AS a, upper(split_part(p_name, ' ', 2)) AS b, p_partkey % 4 AS k, p_size FROM part)
SELECT p_partkey, k IN (0, 1) AND (k = 0 OR length(a) > 3) AS abbreviates, k = 0 AS plural, k = 2 AS contains, k = 3 AS truncated, p_size || ' 4 X' || CASE WHEN k = 1 THEN ' IV' ELSE '' END AS markers FROM n""")
def q_spelling_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, k = F.upper("p_name"), F.col("p_partkey") % 4
    a, b = F.split_part(name, F.lit(" "), F.lit(1)), F.split_part(name, F.lit(" "), F.lit(2))
    other = F.when(k == 0, F.concat(name, F.lit("S"))).when(k == 1, F.concat(F.substring(a, 1, 3), F.lit(" "), b)).when(k == 2, a).otherwise(F.concat(b, F.lit(" ("), a))
    marked = F.concat(name, F.lit(" "), F.col("p_size").cast("string"), F.lit("-X4"), F.when(k == 1, " IV").otherwise(""))
    return table(spark, sf_dir, "part").select(
        "p_partkey", makes.abbreviates(name, other).alias("abbreviates"), makes.plural_of(name, other).alias("plural"), makes.contains_whole_tokens(name, other).alias("contains"),
        makes.is_truncated(other).alias("truncated"), F.array_join(makes.variant_markers(marked), " ").alias("markers"),
    )


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand WHEN p_partkey % 3 = 1 THEN 'PN ' || p_size ELSE '' END AS model FROM part""")
def q_promoted_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    text = F.concat(F.col("p_name"), F.when(k < 2, F.concat(F.lit("\n Part  No : PN  "), F.col("p_size").cast("string"), F.lit(" ,\nmore"))).otherwise("\nmore PART NO: 7"))
    return table(spark, sf_dir, "part").select("p_partkey", ids.promoted_model(F.when(k == 0, F.col("p_brand")).otherwise(""), text).alias("model"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size || '.1' WHEN 3 THEN '' WHEN 1 THEN '' ELSE p_size || '' END AS value,
  CASE p_partkey % 4 WHEN 3 THEN 'ITEM_NO_DATE_SHAPED' WHEN 1 THEN 'ITEM_NO_TOO_LARGE' ELSE '' END AS warning, p_partkey % 4 IN (0, 2) AS ok FROM part""")
def q_item_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    no = F.when(k == 0, F.concat(n, F.lit(".1"))).when(k == 1, (F.col("p_size") + 100).cast("string")).when(k == 3, F.concat(F.lit("05-06-20"), F.lpad(n, 2, "0"))).otherwise(n)
    rows = table(spark, sf_dir, "part").withColumn("v", ids.validated_item_number(no))
    return rows.select("p_partkey", "v.value", "v.warning", ids.item_number_ok(no).alias("ok"))


@query(r"""SELECT conv_id, turn, role, array_to_string(list_transform(regexp_extract_all(coalesce(text, ''), '[\d,]+(?:\.\d+)?'), lambda x: replace(x, ',', '')), '|') AS numbers,
  contains(regexp_replace(coalesce(text, ''), '[^0-9]', '', 'g'), (turn + 10)::VARCHAR) AS verbatim FROM conversations""")
def q_number_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    shown = F.concat(F.lit("Rs. "), (F.col("turn") + 10).cast("string"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.array_join(checks.number_tokens(text), "|").alias("numbers"), checks.is_verbatim(shown, text).alias("verbatim"))


_PLACE = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate)"


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    return table(spark, sf_dir, "lineitem").withColumn("place", F.row_number().over(order))


@query(f"""SELECT l_orderkey, place, coalesce(bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey ORDER BY place ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), false) AS exempt FROM (SELECT *, {_PLACE}::INTEGER AS place FROM lineitem)""")
def q_exempt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.exempt_lines(_placed(spark, sf_dir), "l_orderkey", "place", F.col("l_returnflag") == "R", 3, 0).select("l_orderkey", "place", "exempt")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'Segment ' || left(c_mktsegment, 1) ELSE '[REDACTED]' END AS segment FROM customer""")
def q_remapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame([("MACHINERY", "Segment M"), ("BUILDING", "Segment B")], "value string, replacement string")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"))
    return pii.remap(rows, "segment", known)


@query("""SELECT doc_id, n_chars <= 4000 AND sum((n_chars <= 4000)::INT) OVER w <= 300 AND sum(CASE WHEN n_chars <= 4000 THEN n_chars ELSE 0 END) OVER w <= 250000 AS admitted
FROM documents WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_within_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.within_budget(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 300, 250_000, 4000).select("doc_id", "admitted")


@query(f"""WITH p AS (SELECT l_orderkey, CASE WHEN l_linenumber % 4 <> 3 THEN place END AS e, CASE WHEN l_linenumber % 5 <> 2 THEN place END AS f, l_returnflag = 'N' AS same FROM (SELECT *, {_PLACE} AS place FROM lineitem))
SELECT l_orderkey, CASE WHEN count(f) > 0 THEN count(*) FILTER (WHERE same)::DOUBLE / count(f) END AS precision, CASE WHEN count(e) > 0 THEN count(*) FILTER (WHERE same)::DOUBLE / count(e) END AS recall,
  count(*) FILTER (WHERE same) = count(e) AND count(f) = count(e) AS all_right FROM p GROUP BY l_orderkey""")
def q_example_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _placed(spark, sf_dir).select("l_orderkey", F.when(F.col("l_linenumber") % 4 != 3, F.col("place")).alias("expected_pos"), F.when(F.col("l_linenumber") % 5 != 2, F.col("place")).alias("found_pos"), (F.col("l_returnflag") == "N").alias("same"))
    return examples.accuracy(pairs, "l_orderkey", "same")


@query("""SELECT p_partkey::VARCHAR AS p_partkey, p_name || ', "' || p_type || '"' || chr(10) || 'second line' AS description, '' AS model, coalesce(p_brand, '') AS make FROM part""")
def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with fixed columns (one of them absent), quoted commas, quotes and line breaks; read back as text, beside a file that is not there."""
    path = _scratch(spark, "csv")
    part = table(spark, sf_dir, "part")
    named = part.select("p_partkey", F.concat("p_name", F.lit(', "'), "p_type", F.lit('"\nsecond line')).alias("description"), joins.resolve_column(part, ["Brand", "P_BRAND"]).alias("make"))
    sinks.write_csv(named, path, ["p_partkey", "description", "model", "make"], order="p_partkey")
    tables.require(spark, path)
    back = tables.read_csv(spark, path)
    return back.unionByName(tables.read_optional_csv(spark, path + "-absent", back.schema))


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 'review' ELSE 'ok' END AS table_name FROM orders""")
def q_reviewed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "reviewed")
    sinks.write_reviewed(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), path + "/ok", path + "/review", F.col("o_orderstatus") == "P")
    read = lambda name: spark.read.schema("o_orderkey long, o_orderstatus string").json(f"{path}/{name}").withColumn("table_name", F.lit(name))
    return read("ok").unionByName(read("review"))


@query("""SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type""")
def q_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder in two parts, handled by two runs of a stream: the second takes only what is new, a third nothing."""
    path = _scratch(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    schema = "event_id long, event_type string, value double"
    again = lambda: incremental.process_new(spark, f"{path}/in", schema, f"{path}/mark", f"{path}/out", lambda batch: batch)
    events.where("event_id % 3 = 0").write.parquet(f"{path}/in/a")
    spark.read.parquet(f"{path}/in/a").write.mode("append").parquet(f"{path}/in")
    again()
    events.where("event_id % 3 != 0").write.mode("append").parquet(f"{path}/in")
    again()
    again()
    return spark.read.parquet(f"{path}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("""SELECT doc_id, greatest(length(text), 1) AS n_chars, doc_id % 2 = 0 AS ok, rank::BIGINT AS rank, running::BIGINT AS running FROM (
  SELECT doc_id, text, row_number() OVER (ORDER BY length(text) DESC, doc_id) AS rank, sum(greatest(length(text), 1)) OVER (ORDER BY length(text) DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM documents)""")
def q_running_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.greatest(F.length("text"), F.lit(1)).cast("long").alias("n_chars"), (F.col("doc_id") % 2 == 0).alias("ok"), F.length("text").alias("size"))
    return ranking.with_running(rows, [F.desc("size"), "doc_id"], {"running": "n_chars"}).drop("size")


def _bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bank of all items of orders that have a document (two in three), and of the orders without one."""
    k = F.col("o_orderkey")
    day = F.add_months("o_orderdate", 300)
    orders = table(spark, sf_dir, "orders")
    named = F.when(k % 5 != 0, F.concat(F.lit("Q24W"), F.lpad(k.cast("string"), 8, "0"))).otherwise("-")
    path = F.concat(F.lit("order-"), k.cast("string"), F.lit(".txt"))
    documents = orders.where(k % 3 != 0).select(
        path.alias("source_path"), path.alias("source_file"), named.alias("quotation_number"), F.date_format(day, "yyyy-MM-dd").alias("quotation_date"), F.concat(F.lit("Works "), F.col("o_custkey").cast("string")).alias("customer"),
        F.when(k % 7 != 0, F.col("o_custkey").cast("string")).alias("matched_id"), k.cast("string").alias("matched_order_id"), k.alias("pos"),
    )
    erp = orders.select(k.alias("order_id"), F.col("o_orderstatus").alias("order_status"), F.when(k % 2 == 0, F.date_format(day, "yyyy-MM-dd HH:mm:ss")).alias("order_date"), F.col("o_custkey").cast("string").alias("partner_id"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("description"), F.col("p_brand").alias("make"), F.col("p_type").alias("model"))
    kind = F.col("l_suppkey") % 4
    items = _placed(spark, sf_dir).join(part, "l_partkey").where("l_orderkey % 3 != 0").select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string"), F.lit(".txt")).alias("source_path"), F.col("place").alias("ordinal"), F.lit("").alias("quotation_number"), F.col("place").cast("string").alias("item_no"),
        "description", "make", "model", F.col("l_quantity").alias("quantity"), F.when(kind == 0, "sets").otherwise("Nos.").alias("unit"), F.when(kind.isin(0, 1), F.col("l_tax") + 2).alias("unit_price"),
        F.when(kind.isin(1, 2), F.col("l_quantity") * 4).alias("total_price"), F.when(kind == 2, "LOW").otherwise("HIGH").alias("confidence"),
    )
    return bank.build(items, documents, erp)


BANK_SQL = f"""
d AS (SELECT *, 'order-' || o_orderkey || '.txt' AS path, strftime(o_orderdate + INTERVAL 300 MONTH, '%Y-%m-%d') AS day,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'Q24W' || lpad(o_orderkey::VARCHAR, 8, '0') END AS number FROM orders),
placed AS (SELECT *, {_PLACE}::INTEGER AS place, l_suppkey % 4 AS kind FROM lineitem WHERE l_orderkey % 3 <> 0),
bank AS (
  SELECT 'ATTACHMENT_ITEM' AS data_source, path AS source_path, place AS ordinal, coalesce(number, 'DOC::' || path) AS quotation_key, CASE WHEN number IS NULL THEN 'DOCUMENT_FALLBACK' ELSE 'QUOTATION_NUMBER' END AS quotation_key_basis,
    upper(p_name) AS description, upper(p_brand) AS make, CASE WHEN kind = 0 THEN 'SET' ELSE 'NOS' END AS unit, CASE WHEN kind = 0 THEN 'BUNDLE' ELSE 'COUNT' END AS unit_class,
    CASE WHEN kind IN (0, 1) THEN l_tax + 2 WHEN kind = 2 THEN l_quantity * 4 / l_quantity END AS unit_price, CASE WHEN kind IN (1, 2) THEN l_quantity * 4 WHEN kind = 0 THEN (l_tax + 2) * l_quantity END AS total_price,
    CASE kind WHEN 0 THEN 'DERIVED_FROM_UNIT' WHEN 1 THEN 'REPORTED' WHEN 2 THEN 'DERIVED_FROM_TOTAL' ELSE 'NONE' END AS price_basis, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey::VARCHAR END AS matched_id, o_orderkey::VARCHAR AS order_id,
    o_orderstatus AS order_status, CASE WHEN o_orderkey % 2 = 0 THEN day ELSE day END AS date, CASE WHEN o_orderkey % 2 = 0 THEN 'ERP_ORDER' ELSE 'PARSED_DOC' END AS date_source, kind, true AS is_item
  FROM placed JOIN d ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  UNION ALL SELECT 'ERP_ORDER_ONLY', NULL, NULL, 'ORDER::' || o_orderkey, 'ORDER_FALLBACK', NULL, '', '', '', NULL, NULL, 'NONE', o_custkey::VARCHAR, o_orderkey::VARCHAR, o_orderstatus,
    CASE WHEN o_orderkey % 2 = 0 THEN day ELSE '' END, CASE WHEN o_orderkey % 2 = 0 THEN 'ERP_ORDER' ELSE 'NONE' END, NULL, false FROM d WHERE o_orderkey % 3 = 0
), reasons AS (
  SELECT *, list_filter([CASE WHEN date = '' THEN 'DATE_MISSING' END, CASE WHEN matched_id IS NULL THEN 'NO_MATCHED_CUSTOMER' END, CASE WHEN is_item AND kind = 2 THEN 'LOW_CONFIDENCE_ITEM_WITH_PRICE' END, CASE WHEN is_item AND kind = 3 THEN 'NO_PRICE' END], lambda x: x IS NOT NULL) AS review_reasons FROM bank
)"""
_BANK_COLUMNS = ["data_source", "source_path", "ordinal", "quotation_key", "quotation_key_basis", "make", "unit", "unit_class", "unit_price", "total_price", "price_basis", "matched_id", "order_id", "order_status", "date", "date_source"]


@query(f"WITH {BANK_SQL} SELECT {', '.join(_BANK_COLUMNS)}, array_to_string(review_reasons, '; ') AS reasons FROM reasons")
def q_item_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bank(spark, sf_dir).select(*_BANK_COLUMNS, F.array_join("review_reasons", "; ").alias("reasons"))


@query(f"WITH {BANK_SQL} SELECT data_source, source_path, ordinal, order_id, unnest(review_reasons) AS reason FROM reasons")
def q_item_bank_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank.review(_bank(spark, sf_dir))


@query(f"WITH {BANK_SQL} SELECT source_path AS document, ordinal AS row, quotation_key AS quotation, unit_price AS price FROM bank")
def q_item_bank_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank.slim(_bank(spark, sf_dir), {"source_path": "document", "ordinal": "row", "quotation_key": "quotation", "unit_price": "price"})


@query(f"""WITH {BANK_SQL} SELECT quotation_key, array_to_string(list_sort(list_distinct(flatten(list(review_reasons)))), '; ') AS reasons FROM reasons WHERE source_path IS NOT NULL GROUP BY quotation_key HAVING len(flatten(list(review_reasons))) > 0""")
def q_quotation_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bank(spark, sf_dir)
    return bank.reasons_by_quotation(rows, bank.review(rows)).select("quotation_key", F.array_join("reasons", "; ").alias("reasons"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'SIEMENS AG' WHEN 1 THEN 'AMETEK' WHEN 2 THEN 'SICK GMBH' WHEN 3 THEN 'own' WHEN 4 THEN 'AMETEK' END AS make,
  CASE WHEN p_partkey % 6 IN (0, 1, 2) THEN 'GX ' || p_size WHEN p_partkey % 6 = 3 THEN 'given' END AS model, CASE WHEN p_partkey % 4 = 0 THEN 'PN-' || p_partkey || '/7' END AS part_number FROM part""")
def q_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Makes by label, behind a model, misread, by name and given ones; models that stop at a word, a count or another label."""
    k, size = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    line = F.when(k == 0, F.concat(F.lit("\nMake : Siemens AG 7MB\nModel No: GX "), size, F.lit(" with display"))).when(k == 1, F.concat(F.lit("\nMODEL: GX "), size, F.lit(", AMETEK\nQty 2")))
    line = line.when(k == 2, F.concat(F.lit("\nMfg- SICK GmbH probe\nModel- GX "), size, F.lit(" 2 Nos"))).when(k == 3, "\nMake: ABB\nModel: X").when(k == 4, " as FUJI or AMTEK").otherwise(" of any origin")
    part_no = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("\nP/N: PN-"), F.col("p_partkey").cast("string"), F.lit("/7."))).otherwise("")
    filled = backfill.backfilled(F.concat(F.col("p_name"), line, part_no), F.when(k == 3, "own").otherwise(""), F.when(k == 3, "given"), F.lit(None).cast("string"))
    return table(spark, sf_dir, "part").withColumn("b", filled).select("p_partkey", F.upper("b.make").alias("made"), "b.model", "b.part_number").select("p_partkey", F.when(F.col("made") == "OWN", "own").otherwise(F.col("made")).alias("make"), "model", "part_number")
