"""Item bank, quotation roll-up, scores and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import joins, profile, rollup, scoring
from tallyloom.plans import query
from tallyloom.sources.tables import table

ITEMS_SQL = """
items AS (
  SELECT l_orderkey AS key, l_linenumber::BIGINT * 1000000000000 + l_partkey * 1000000 + l_suppkey AS pos, CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_orderkey % 9 = 0 AND l_linenumber = 1 THEN -l_extendedprice ELSE l_extendedprice END AS total,
    CASE WHEN l_linenumber % 3 = 0 THEN 'DERIVED_FROM_UNIT' ELSE 'REPORTED' END AS basis, ['HIGH', 'MEDIUM', 'LOW'][(l_partkey % 3 + 1)::INT] AS confidence,
    'M' || (l_suppkey % 20) AS make, CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE l_shipmode END AS mode, l_linenumber % 4 = 0 AS dated FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem))"""


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    total = F.when(n % 5 == 0, F.lit(None)).when((k % 9 == 0) & (n == 1), -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return table(spark, sf_dir, "lineitem").select(
        k.alias("key"),
        (n.cast("long") * 1000000000000 + F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("pos"),
        total.alias("total"),
        F.when(n % 3 == 0, "DERIVED_FROM_UNIT").otherwise("REPORTED").alias("basis"),
        F.element_at(F.array(F.lit("HIGH"), F.lit("MEDIUM"), F.lit("LOW")), (F.col("l_partkey") % 3 + 1).cast("int")).alias("confidence"),
        F.concat(F.lit("M"), (F.col("l_suppkey") % 20).cast("string")).alias("make"),
        F.when(n % 2 == 0, "").otherwise(F.concat("l_returnflag", "l_linestatus")).alias("mode"),
        (n % 4 == 0).alias("dated"),
    )


SUM_SQL = """
  sum(total::DECIMAL(20,4)) FILTER (WHERE total >= 0)::DOUBLE AS total_value, count(*) FILTER (WHERE total >= 0) AS n_priced, count(*) FILTER (WHERE total < 0) AS n_negative,
  CASE WHEN count(*) FILTER (WHERE total >= 0) = 0 THEN 'NONE' WHEN count(*) FILTER (WHERE total >= 0) < count(*) THEN 'PARTIAL'
    WHEN count(DISTINCT basis) FILTER (WHERE total >= 0) = 1 AND min(basis) FILTER (WHERE total >= 0) = 'REPORTED' THEN 'REPORTED' ELSE 'MIXED_DERIVED' END AS value_basis"""
LIST_SQL = """
  CASE WHEN len(ms) > 10 THEN list_aggregate(ms[1:10], 'string_agg', '; ') || '; …+' || (len(ms) - 10) || ' more' ELSE list_aggregate(ms, 'string_agg', '; ') END"""
BEST_SQL = "arg_min(mode, (-(dated::INT), -(CASE confidence WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END), pos)) FILTER (WHERE mode <> '')"


@query(f"WITH {ITEMS_SQL} SELECT key, {SUM_SQL} FROM items GROUP BY key")
def q_priced_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = rollup.priced_sum(F.col("total"), F.col("basis"))
    return _items(spark, sf_dir).groupBy("key").agg(*[c.alias(n) for n, c in sums.items()])


@query(f"WITH {ITEMS_SQL} SELECT key, {BEST_SQL} AS mode FROM items GROUP BY key")
def q_best_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).groupBy("key").agg(rollup.best_scalar(F.col("mode"), F.col("dated"), F.col("confidence"), F.col("pos")).alias("mode"))


@query(f"WITH {ITEMS_SQL}, g AS (SELECT key % 500 AS g, list_sort(list_distinct(list(make))) AS ms FROM items GROUP BY 1) SELECT g, {LIST_SQL} AS makes FROM g")
def q_capped_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).groupBy((F.col("key") % 500).alias("g")).agg(rollup.capped_list(F.col("make")).alias("makes"))


@query(f"""WITH {ITEMS_SQL}, g AS (SELECT key, count(*) AS n_items, {SUM_SQL}, count(*) FILTER (WHERE confidence = 'HIGH') AS n_high, count(*) FILTER (WHERE confidence = 'MEDIUM') AS n_medium, count(*) FILTER (WHERE confidence = 'LOW') AS n_low,
  list_sort(list_distinct(list(make))) AS ms, {BEST_SQL} AS mode FROM items GROUP BY key)
SELECT * EXCLUDE (ms), {LIST_SQL} AS make_list FROM g""")
def q_quotation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.roll_up(_items(spark, sf_dir), "key", "total", "basis", "confidence", "pos", ["make"], ["mode"], "dated")


@query(f"WITH {ITEMS_SQL} SELECT count(*) AS items_in, count(*) AS items_out, 0::BIGINT AS bad_keys, 0::BIGINT AS negative_totals, true AS ok FROM items")
def q_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    rolled = rollup.roll_up(items, "key", "total", "basis", "confidence", "pos", ["make"], ["mode"], "dated")
    return rollup.conservation(items, rolled, "key")


@query("""SELECT 'ATTACHMENT_ITEM' AS data_source, l_orderkey AS order_id, l_linenumber::VARCHAR AS item_no, l_extendedprice AS total, NULL::VARCHAR AS status FROM lineitem
UNION ALL SELECT 'ERP_ORDER_ONLY', o_orderkey, NULL, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def q_item_bank_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    mine = items.select(F.lit("ATTACHMENT_ITEM").alias("data_source"), F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").cast("string").alias("item_no"), F.col("l_extendedprice").alias("total"))
    rest = joins.unlinked(table(spark, sf_dir, "orders"), "o_orderkey", items.where("l_returnflag = 'R'"), "l_orderkey")
    other = rest.select(F.lit("ERP_ORDER_ONLY").alias("data_source"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status"))
    return joins.union_kinds(mine, other, ["data_source", "order_id", "item_no", "total", "status"])


@query("""WITH t AS (SELECT count(*) AS n, count(o_orderkey) AS a, count(*) FILTER (WHERE o_orderstatus <> 'O') AS b, count(*) FILTER (WHERE o_orderpriority NOT LIKE '1%') AS c FROM orders)
SELECT 'o_orderkey' AS column_name, a AS n_filled, round(a * 100.0 / n, 2)::DOUBLE AS percent FROM t UNION ALL SELECT 'o_orderstatus', b, round(b * 100.0 / n, 2)::DOUBLE FROM t UNION ALL SELECT 'o_orderpriority', c, round(c * 100.0 / n, 2)::DOUBLE FROM t""")
def q_fill_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).otherwise(" ").alias("o_orderstatus"), F.when(~F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority")).alias("o_orderpriority"))
    return profile.fill_rates(rows.withColumn("o_orderkey", F.col("o_orderkey").cast("string")), ["o_orderkey", "o_orderstatus", "o_orderpriority"])


@query("SELECT CASE WHEN o_orderstatus = 'O' THEN '(blank)' ELSE o_orderstatus END AS value, count(*) AS n FROM orders GROUP BY 1")
def q_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(table(spark, sf_dir, "orders").withColumn("s", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))), "s")


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, CASE WHEN (l_orderkey + l_linenumber) % 4 <> 0 THEN l_returnflag ELSE '' END AS flag FROM lineitem
), c AS (SELECT l_orderkey, flag, count(*) AS n FROM r WHERE flag <> '' GROUP BY ALL
), t AS (SELECT l_orderkey, sum(n) AS labelled, arg_min(flag, (-n, flag)) AS top, max(n) AS n FROM c GROUP BY l_orderkey)
SELECT r.l_orderkey, l_linenumber, CASE WHEN flag <> '' THEN flag WHEN labelled >= 3 AND n >= 0.8 * labelled THEN top END AS filled FROM r LEFT JOIN t USING (l_orderkey)""")
def q_dominant_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 4 != 0, F.col("l_returnflag")).otherwise("")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", flag.alias("flag"))
    return scoring.dominant_fill(rows, "l_orderkey", "flag").select("l_orderkey", "l_linenumber", "filled")


@query(f"""WITH {ITEMS_SQL}, p AS (SELECT *, key % 2 = 0 AS v, CASE WHEN key % 3 = 0 THEN 2.0 END AS q, total / 2 AS u FROM items)
SELECT count(*) AS n_items, round(count(*) FILTER (WHERE coalesce(u, total) < 0) * 100.0 / count(*), 2)::DOUBLE AS negative_pct, round(count(*) FILTER (WHERE coalesce(u, total) >= 0 AND coalesce(u, total) < 1000) * 100.0 / count(*), 2)::DOUBLE AS small_pct,
  round(count(*) FILTER (WHERE total IS NULL) * 100.0 / count(*), 2)::DOUBLE AS no_price_pct, count(*) FILTER (WHERE q IS NOT NULL AND total IS NOT NULL) AS n_checkable, 100.0::DOUBLE AS arithmetic_ok_pct, round(count(*) FILTER (WHERE v) * 100.0 / count(*), 2)::DOUBLE AS verbatim_pct FROM p""")
def q_self_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.self_consistency(_items(spark, sf_dir), F.col("total") / 2, F.col("total"), F.when(F.col("key") % 3 == 0, F.lit(2.0)), F.col("key") % 2 == 0)


@query("""WITH c AS (SELECT doc_id, arg_max(lang, doc_id) AS lang, max(n_chars) + (doc_id % 4) AS n_chars FROM documents WHERE doc_id % 5 <> 0 GROUP BY doc_id),
g AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'XX' ELSE upper(d.lang) END AS want, d.n_chars AS want_n FROM documents d JOIN labels USING (doc_id))
SELECT 'lang' AS field, count(*) FILTER (WHERE c.lang IS NOT NULL AND lower(want) = c.lang) AS exact, count(*) FILTER (WHERE c.lang IS NOT NULL AND lower(want) <> c.lang) AS wrong, count(*) FILTER (WHERE c.lang IS NULL) AS missing FROM g LEFT JOIN c USING (doc_id)
UNION ALL SELECT 'n_chars', count(*) FILTER (WHERE c.n_chars IS NOT NULL AND abs(want_n - c.n_chars) <= 1), count(*) FILTER (WHERE c.n_chars IS NOT NULL AND abs(want_n - c.n_chars) > 1), count(*) FILTER (WHERE c.n_chars IS NULL) FROM g LEFT JOIN c USING (doc_id)""")
def q_golden_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    golden = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id").withColumn("lang", F.when(F.col("doc_id") % 7 == 0, "XX").otherwise(F.upper("lang")))
    found = docs.where("doc_id % 5 != 0").withColumn("n_chars", F.col("n_chars") + F.col("doc_id") % 4).withColumn("pos", F.col("doc_id"))
    return scoring.golden_score(golden, found, ["doc_id"], ["lang", "n_chars"], ["n_chars"], "pos")


@query("""WITH g AS (SELECT d.doc_id, d.source, row_number() OVER (ORDER BY d.doc_id) - 1 AS r, count(*) OVER () AS n FROM documents d JOIN labels l USING (doc_id) WHERE quality = 1 AND toxic = 0)
SELECT doc_id, source FROM g WHERE r % greatest(1, n // 20) = 0 AND r < greatest(1, n // 20) * 20""")
def q_good_bad_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id"), "doc_id")
    return scoring.strided_sample(good, "doc_id", 20)


@query("""WITH q AS (SELECT source, greatest(1, floor(count(*) * 50 / (SELECT count(*) FROM documents))) AS quota FROM documents GROUP BY source),
r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('7:' || doc_id)) AS r FROM documents)
SELECT doc_id, source FROM r JOIN q USING (source) WHERE r <= quota""")
def q_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.stratified_sample(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id", 50, 7)


@query("""SELECT event_id, (props::JSON ->> '$.page') AS page, (props::JSON ->> '$.page') IS NOT NULL AS valid FROM events""")
def q_json_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.try_parse_json("props")
    page = F.try_variant_get(v, "$.page", "string")
    return table(spark, sf_dir, "events").select("event_id", page.alias("page"), page.isNotNull().alias("valid"))
