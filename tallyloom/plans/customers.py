"""Orders, customers and their resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import ids
from tallyloom.operators import joins, orders, resolve
from tallyloom.plans import query
from tallyloom.sources.tables import read_optional_csv, table  # noqa: F401

HISTORY = """
  SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total_value,
    string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS regions,
    max(o_orderdate) AS latest_date, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS latest_status, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest_pos
  FROM orders GROUP BY o_custkey"""
STATUS = """
  SELECT o_custkey, string_agg(o_orderstatus || ':' || n, ', ' ORDER BY o_orderstatus || ':' || n) AS status_counts
  FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey"""
MODE = """
  SELECT o_custkey, o_orderpriority AS industry, n_value, n FROM (
    SELECT *, sum(n_value) OVER (PARTITION BY o_custkey)::BIGINT AS n,
      row_number() OVER (PARTITION BY o_custkey ORDER BY n_value DESC, latest DESC, first_pos) AS r
    FROM (SELECT o_custkey, o_orderpriority, count(*) AS n_value, max(o_orderdate) AS latest, min(o_orderkey) AS first_pos FROM orders GROUP BY ALL)
  ) WHERE r = 1"""


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_history(_orders(spark, sf_dir), "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_orderkey")


@query(f"SELECT h.*, status_counts FROM ({HISTORY}) h JOIN ({STATUS}) s USING (o_custkey)")
def q_order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)


@query(MODE)
def q_industry_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.mode_with_ties(_orders(spark, sf_dir), "o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey").withColumnRenamed("o_orderpriority", "industry")


@query(f"""
SELECT c.c_custkey, c.c_name, n.n_name, n_orders, total_value, status_counts, latest_date, latest_status, industry,
  n_value || ' of ' || m.n || ' orders' AS industry_confidence
FROM customer c JOIN nation n ON c_nationkey = n_nationkey
LEFT JOIN ({HISTORY}) h ON c_custkey = h.o_custkey LEFT JOIN ({STATUS}) s ON c_custkey = s.o_custkey LEFT JOIN ({MODE}) m ON c_custkey = m.o_custkey""")
def q_customer_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is each customer: usual industry with its share, order count, value, statuses, latest order."""
    rename = lambda df: df.withColumnRenamed("o_custkey", "c_custkey")
    master = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    out = orders.customer_directory(master, "c_custkey", rename(_history(spark, sf_dir)), rename(q_industry_mode(spark, sf_dir)))
    return out.select("c_custkey", "c_name", "n_name", "n_orders", "total_value", "status_counts", "latest_date", "latest_status", "industry", orders.confidence_text(F.col("n_value"), F.col("n")).alias("industry_confidence"))


@query("""
SELECT o_custkey, count(*) AS n, arg_max(o_orderstatus, (o_orderdate, -o_orderkey)) AS o_orderstatus, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS o_orderkey
FROM orders GROUP BY o_custkey""")
def q_representative_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).withColumn("o_custkey", F.col("o_custkey").cast("string"))
    out = orders.representative_order(rows, "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return out.withColumn("o_custkey", F.col("o_custkey").cast("long"))


@query("""
SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus, o.o_orderkey IS NOT NULL AS found
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 3 <> 0) o ON l_orderkey = o_orderkey""")
def q_items_left_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = _orders(spark, sf_dir).where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderdate")
    return joins.left_lookup(table(spark, sf_dir, "lineitem"), right, "l_orderkey", "o_orderdate").select("l_orderkey", "l_linenumber", "o_custkey", "o_orderstatus", "found")


LATE = "SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'"


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN ({LATE})")
def q_orders_unlinked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.unlinked(_orders(spark, sf_dir), "o_orderkey", table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"), "l_orderkey").select("o_orderkey", "o_custkey")


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN ({LATE})")
def q_orders_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.linked(_orders(spark, sf_dir), "o_orderkey", table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"), "l_orderkey").select("o_orderkey", "o_custkey")


@query("""
SELECT d.doc_id, coalesce(a.quality, b.quality) AS quality, CASE WHEN a.doc_id IS NOT NULL THEN 1 WHEN b.source IS NOT NULL THEN 2 END AS matched_by
FROM documents d LEFT JOIN labels a ON d.doc_id = a.doc_id
LEFT JOIN (SELECT source, arg_max(quality, doc_id) AS quality FROM labels JOIN documents USING (doc_id) GROUP BY source) b ON d.source = b.source""")
def q_fallback_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").join(docs, "doc_id").select(F.col("doc_id").alias("l_id"), F.col("source").alias("l_source"), "quality")
    return joins.fallback_join(docs, labels, ("doc_id", "l_id"), ("source", "l_source"), ["quality"], "l_id").select("doc_id", "quality", "matched_by")


@query("""
SELECT c_custkey, c.c_name, v.id AS override_id, s.s_name AS override_name FROM customer c
LEFT JOIN (VALUES ('customer#000000001', 3), ('customer#000000002', 999999999), ('customer#000000005', 7)) v(t, id) ON lower(trim(c.c_name)) = t
LEFT JOIN supplier s ON v.id = s.s_suppkey""")
def q_override_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = spark.createDataFrame([("CUSTOMER#000000001", 3), ("customer#000000002", 999999999), ("customer#000000005 ", 7)], "text string, override_id int")
    over = over.withColumn("text", F.lower(F.trim("text")))
    master = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("override_name"))
    rows = table(spark, sf_dir, "customer").withColumn("text", F.lower(F.trim("c_name")))
    return rows.join(F.broadcast(over), "text", "left").join(master, F.col("override_id") == F.col("s_suppkey"), "left").select("c_custkey", "c_name", "override_id", "override_name")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with request numbers Q24W<n> and revisions R<k>, written with stray spaces and mixed case."""
    n = F.col("o_orderkey") % 4000
    text = F.concat(F.lit(" q24 w"), F.lpad(n.cast("string"), 5, "0"), F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("r"), (F.col("o_orderkey") % 4).cast("string"))).otherwise(F.lit("")))
    return _orders(spark, sf_dir).withColumn("request_text", text)


NUMBERED = """
numbered AS (
  SELECT *, upper(regexp_replace(' q24 w' || lpad((o_orderkey % 4000)::VARCHAR, 5, '0') || CASE WHEN o_orderkey % 3 = 0 THEN 'r' || (o_orderkey % 4) ELSE '' END, '\\s+', '', 'g')) AS request
  FROM orders
), index AS (
  SELECT request, count(DISTINCT o_custkey) AS n_partners, string_agg(DISTINCT c_name, ' / ' ORDER BY c_name) AS partner_names, min(o_custkey) AS partner, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS order_pos
  FROM numbered JOIN customer ON o_custkey = c_custkey GROUP BY request
)"""


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _numbered(spark, sf_dir).join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    return resolve.number_index(named, "request_text", "o_custkey", "c_name", "o_orderdate", "o_orderkey")


@query(f"WITH {NUMBERED} SELECT * FROM index")
def q_rfq_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir)


@query(f"WITH {NUMBERED} SELECT request, n_partners, partner_names FROM index WHERE n_partners > 1")
def q_rfq_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).where("n_partners > 1").select("request", "n_partners", "partner_names")


WANTED = """
wanted AS (
  SELECT p_partkey, 'Q24W' || lpad((p_partkey % 4000)::VARCHAR, 5, '0') || CASE WHEN p_partkey % 2 = 0 THEN 'R' || (p_partkey % 7) ELSE '' END AS request FROM part
), based AS (SELECT *, regexp_extract(request, '^(.*?)(R\\d+)$', 1) AS base FROM wanted)"""


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    number = F.concat(F.lit("Q24W"), F.lpad((k % 4000).cast("string"), 5, "0"), F.when(k % 2 == 0, F.concat(F.lit("R"), (k % 7).cast("string"))).otherwise(F.lit("")))
    return table(spark, sf_dir, "part").select("p_partkey", number.alias("request"))


@query(f"""WITH {NUMBERED}, {WANTED}
SELECT p_partkey, b.request, base, coalesce(x.partner, y.partner) AS partner, CASE WHEN x.request IS NOT NULL THEN 'EXACT' WHEN y.request IS NOT NULL THEN 'BASE' ELSE 'NONE' END AS how
FROM based b LEFT JOIN index x ON b.request = x.request LEFT JOIN index y ON b.base = y.request""")
def q_rfq_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    rows = _wanted(spark, sf_dir).withColumn("base", ids.base_number(F.col("request")))
    x = index.select("request", F.struct("partner").alias("x"))
    y = index.select(F.col("request").alias("base"), F.struct("partner").alias("y"))
    out = rows.join(x, "request", "left").join(y, "base", "left")
    how = F.when(F.col("x").isNotNull(), "EXACT").when(F.col("y").isNotNull(), "BASE").otherwise("NONE")
    return out.select("p_partkey", "request", "base", F.coalesce("x", "y")["partner"].alias("partner"), how.alias("how"))


@query(f"""WITH {NUMBERED}, {WANTED}, hit AS (
  SELECT b.*, CASE WHEN x.request IS NOT NULL THEN x.n_partners ELSE y.n_partners END AS n_partners, x.request IS NOT NULL AS exact,
    CASE WHEN x.request IS NOT NULL THEN x.partner ELSE y.partner END AS partner, CASE WHEN x.request IS NOT NULL THEN x.order_pos ELSE y.order_pos END AS order_pos
  FROM based b LEFT JOIN index x ON b.request = x.request LEFT JOIN index y ON b.base = y.request
), told AS (
  SELECT *, CASE WHEN p_partkey % 11 = 0 THEN 'MISSING' WHEN p_partkey % 13 = 0 THEN 'OVERRIDE' WHEN n_partners > 1 THEN 'RFQ_AMBIGUOUS'
    WHEN n_partners = 1 THEN CASE WHEN exact THEN 'RFQ_MATCH' ELSE 'RFQ_MATCH_BASE' END WHEN p_partkey % 3 = 0 THEN 'EXACT' ELSE 'NO_MATCH' END AS match_status FROM hit
)
SELECT p_partkey, match_status, CASE WHEN match_status = 'OVERRIDE' THEN 1 WHEN match_status LIKE 'RFQ_MATCH%' THEN partner WHEN match_status = 'EXACT' THEN p_partkey % 100 END AS matched_id,
  CASE WHEN match_status LIKE 'RFQ_MATCH%' THEN order_pos END AS matched_order FROM told""")
def q_rfq_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    text = F.when(k % 11 == 0, "  ").when(k % 13 == 0, "The Known One").when(k % 3 == 0, F.concat(F.lit("CUSTOMER # "), F.lpad((k % 100).cast("string"), 9, "0"))).otherwise("zzzz")
    quotes = _wanted(spark, sf_dir).withColumnRenamed("request", "quotation_number").withColumn("customer", text)
    master = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("pos"))
    over = spark.createDataFrame([("the known one", 1)], "quotation_customer_text string, customer_id long")
    out = resolve.resolve_customers(quotes, master, _index(spark, sf_dir), over)
    return out.select("p_partkey", "match_status", "matched_id", "matched_order")


@query("""
WITH t AS (SELECT min(p_partkey) AS id, lower(p_name) AS t FROM part GROUP BY lower(p_name)),
j AS (SELECT x.id AS a, y.id AS b, len(list_intersect(list_distinct(string_split(x.t, ' ')), list_distinct(string_split(y.t, ' '))))::DOUBLE
  / len(list_distinct(list_concat(string_split(x.t, ' '), string_split(y.t, ' ')))) AS overlap FROM t x JOIN t y ON x.id < y.id)
SELECT * FROM j WHERE overlap >= 0.3""")
def q_fuzzy_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").groupBy(F.lower("p_name").alias("t")).agg(F.min("p_partkey").alias("id"))
    return resolve.overlap_pairs(names, "id", "t", 0.3)


@query()
def q_fuzzy_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decorated supplier names against the part names and a few companies; sequence similarity has no SQL form."""
    words = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("id"))
    asked = words.select(F.concat(F.lit("M/s. "), F.initcap("p_name"), F.lit(" Pvt. Ltd.")).alias("customer"))
    master = words.select("id", F.concat(F.col("p_name"), F.lit(" private limited")).alias("name"), F.col("id").alias("pos"))
    return resolve.fuzzy_best(asked, master, "customer", "id", "name", "pos")


@query("""
SELECT event_type, user_id, arg_min(event_id, ts) AS event_id, min(ts) AS ts FROM events GROUP BY ALL""")
def q_dedup_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", "user_id", "event_id", "ts")
    return joins.keep_first(rows, ["event_type", "user_id"], "ts").select("event_type", "user_id", "event_id", "ts")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have no result yet."""
    return joins.unlinked(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")
