"""DataFrame operators on small tables."""

import datetime

from pyspark.sql import functions as F

from tallyloom.operators import layout, lines, orders, pii, profile, resolve, rollup, scoring, suggest
from tests.samples import OFFER
from tallyloom.sources import documents, paged, sinks
from tallyloom.sources.tables import MissingInputs, read_csv, read_optional_csv, require
from tallyloom.streaming import incremental


def test_mode_prefers_later_then_first(spark):
    day = lambda m: datetime.datetime(2024, m, 1)
    rows = [(1, "A", day(1), 0), (1, "B", day(2), 1), (1, "A", None, 2), (1, "B", None, 3), (2, "C", None, 4), (2, "D", None, 5), (3, " ", None, 6), (None, "A", None, 7), (4, "", None, 8)]
    got = {r["k"]: (r["v"], r["n_value"], r["n"]) for r in orders.mode_with_ties(spark.createDataFrame(rows, "k int, v string, d timestamp, p int"), "k", "v", "d", "p").collect()}
    assert got[1] == ("B", 2, 4) and got[2] == ("C", 1, 2) and 4 not in got


def test_priced_sums(spark):
    rows = [("a", 100.0, "REPORTED"), ("a", 50.0, "REPORTED"), ("b", 100.0, "REPORTED"), ("b", -5.0, "REPORTED"), ("c", 100.0, "REPORTED"), ("c", 50.0, "DERIVED_FROM_UNIT"), ("d", None, "NONE")]
    sums = rollup.priced_sum(F.col("t"), F.col("b"))
    got = {r["k"]: (r["total_value"], r["value_basis"], r["n_negative"]) for r in spark.createDataFrame(rows, "k string, t double, b string").groupBy("k").agg(*[c.alias(n) for n, c in sums.items()]).collect()}
    assert got == {"a": (150.0, "REPORTED", 0), "b": (100.0, "PARTIAL", 1), "c": (150.0, "MIXED_DERIVED", 0), "d": (None, "NONE", 0)}
    many = spark.createDataFrame([(f"v{i:02d}",) for i in range(12)], "v string").agg(rollup.capped_list(F.col("v"))).first()[0]
    assert many == "; ".join(f"v{i:02d}" for i in range(10)) + "; …+2 more"


def test_cascade(spark):
    master = spark.createDataFrame([("1", "Blue Harbour Works", 0), ("2", "Green Hill", 1)], "id string, name string, pos int")
    sale = spark.createDataFrame([("Q24W10132", "1", "Blue Harbour Works", None, 0), ("Q24W2", "1", "B", None, 1), ("Q24W2", "2", "G", None, 2)], "n string, p string, pn string, d timestamp, pos int")
    index = resolve.number_index(sale, "n", "p", "pn", "d", "pos")
    over = spark.createDataFrame([("Odd One", "2")], "quotation_customer_text string, customer_id string")
    quotes = spark.createDataFrame([(" ", "Q24W10132"), ("odd one", "Q24W10132"), ("x", "q24 w10132"), ("x", "Q24W10132R3"), ("x", "Q24W2"), ("M/s Blue Harbour Works", ""), ("qqq", ""), (None, None)], "customer string, quotation_number string")
    got = [(r["match_status"], r["matched_id"]) for r in resolve.resolve_customers(quotes, master, index, over).orderBy("customer", "quotation_number").collect()]
    assert sorted(got, key=repr) == sorted([("MISSING", None), ("OVERRIDE", "2"), ("RFQ_MATCH", "1"), ("RFQ_MATCH_BASE", "1"), ("RFQ_AMBIGUOUS", None), ("EXACT", "1"), ("NO_MATCH", None), ("MISSING", None)], key=repr)


def test_chains_and_pairs(spark):
    links = spark.createDataFrame([(f"s{i}", f"s{i + 1}") for i in range(20)], "alias string, canonical string")
    assert {r["canonical"] for r in suggest.follow_chains(links).collect()} == {"s20"}
    rows = spark.createDataFrame([("MICHELL",)] * 10 + [("MICHELL INSTRUMENTS",)] * 5 + [("MITCHELL INSTRUMENTS",)] * 2 + [("OXYMAT 61",), ("OXYMAT 64",), ("OXYMAT 64",)], "s string")
    pairs = suggest.follow_chains(suggest.alias_pairs(suggest.ranked_spellings(rows, "s")).select("alias", "canonical"))
    got = {r["alias"]: r["canonical"] for r in pairs.collect()}
    assert got == {"MICHELL INSTRUMENTS": "MICHELL", "MITCHELL INSTRUMENTS": "MICHELL"}


def test_profiles(spark):
    docs = spark.createDataFrame([(1, " same\r\ntext"), (2, "same\ntext "), (3, "other"), (4, ""), (5, None)], "k int, text string")
    assert sorted((r["k"], r["group_size"]) for r in profile.exact_duplicates(docs, "k", "text").collect()) == [(1, 2), (2, 2)]
    assert profile.document_profile(docs, "k", "text").where("k = 5").first()["status"] == "EMPTY"
    assert {r["column_name"]: r["percent"] for r in profile.fill_rates(docs, ["text"]).collect()} == {"text": 60.0}


def test_greedy_matching(spark):
    a = spark.createDataFrame([("x", 0, "1"), ("x", 1, "2"), ("x", 2, "9")], "e string, pos long, item_no string")
    b = spark.createDataFrame([("x", 0, "2"), ("x", 1, None)], "e string, pos long, item_no string")
    assert sorted(map(tuple, scoring.greedy_match(a, b, "e").collect())) == sorted([("x", 0, 0), ("x", 1, 1), ("x", 2, None)], key=lambda t: t[1])


def test_lines():
    parsed = lines.parse_lines(OFFER.splitlines())
    assert [i.item_no for i in parsed["items"]] == ["1", "2", "3"] and parsed["document_confidence"] == "HIGH"
    assert lines.note_lines(["Note:", "1. a", "2. b", "3"]) == {1, 2} or lines.note_lines(["Note", "1. a", "2. b", "3"]) == {0, 1, 2}
    assert lines.item_starts(["150", "Meters", "Notes", "1. a", "2. b", "3"]) == [5]
    assert lines.number_in("CAPACITY) QTY-2") == -2 and lines.strict_number("CAPACITY) QTY-2") is None
    assert lines.parse_lines([])["document_confidence"] == "LOW"


def test_layout():
    w = lambda t, x, y: layout.Word(x, y, x + 5 * len(t), y + 8, t)
    bands = [layout.Band("quantity", 0, 30), layout.Band("unit_price", 40, 90), layout.Band("total_price", 100, 160)]
    rows = [[w("2", 0, y), w(p, 110, y)] for y, p in ((100, "25,64,400"), (120, "1,56,200"), (140, "13,50,800"))]
    assert len(layout.segment(rows, bands, [80, 200])) == 3 and len(layout.segment(rows[:1], bands, [80, 200])) == 1
    assert layout.infer_bands([]) is None and layout.infer_bands([w("a", 0, 0), w("b", 0, 20)]) is None
    third = [w("1", 0, 0), w("Widget", 20, 0), w("1 No.", 120, 0), w("2", 0, 20), w("Gasket", 20, 20), w("20 Meters", 120, 20), w("3", 0, 40), w("Kit", 20, 40), w("1 Lot", 120, 40)]
    assert [b.field for b in layout.infer_bands(third)] == ["item_no", "description", "quantity"]
    assert [layout.header_field(x) for x in ("Item Description", "Item", "Total Price", "SR.NO.", "S.No")] == ["description", "item_no", "total_price", "item_no", "item_no"]
    assert layout.header_field("Total", unit_price_seen=False) is None
    assert layout.centred_cuts([0, 10, 20, 40, 50, 60], [1, 4]) == [3]


def test_masking(spark):
    text = "Call +91 98765 43210 or a.b@x.com, b@own.com: 12,34,567.00"
    row = spark.createDataFrame([(text,)], "t string")
    assert row.select(pii.mask(F.col("t"), ["own.com"])).first()[0] == "Call [PHONE] or [EMAIL], b@own.com: [AMOUNT]"
    shaped = row.select(pii.same_shape_number(F.lit("12,345.60"), F.lit("doc"))).first()[0]
    assert len(shaped) == 9 and shaped[2] == "," and shaped[6] == "." and shaped[0] != "0"


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("Quotation Number: Q1\nBOQ Status: FOUND\nx\ny")
    corpus = documents.text_corpus(spark, str(tmp_path / "in"), limit=5)
    row = documents.split_table_text(corpus).first()
    assert (row["source_file"], row["quotation_number"], row["boq_status"], row["body"]) == ("a.txt", "Q1", "FOUND", "x\ny")
    (tmp_path / "t.csv").write_text('﻿a,b\n"1\n2",\n', encoding="utf-8")
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "t.csv")).collect()] == [("1\n2", "")]
    assert read_optional_csv(spark, str(tmp_path / "none.csv"), "a string").count() == 0
    try:
        require(spark, str(tmp_path / "none.csv"))
        raise AssertionError
    except MissingInputs as e:
        assert "none.csv" in str(e)
    sinks.write_csv(spark.createDataFrame([("2", "x"), ("1", None)], "k string, v string"), str(tmp_path / "out"), ["k", "v", "w"], order="k", single=True)
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "out")).collect()] == [("1", "", ""), ("2", "x", "")]
    made = documents.read_pages(spark.createDataFrame([("p", bytearray(b"abc"))], "path string, content binary"), lambda b: ["x" * 60], None).first()
    assert made["status"] == "SUCCESS" and made["kind"] == "TEXT_BASED"
    answers = spark.createDataFrame([("d", 'ok ```{"products": [{"product_name": "A", "quantity": 2, "unit_price": "Quoted"}, {"product_name": "", "quantity": 1}]}```'), ("e", "nothing")], "k string, j string")
    got = {r["k"]: (r["accepted"], r["n"]) for r in documents.valid_products(answers, "j").select("k", "accepted", F.size("products").alias("n")).collect()}
    assert got["d"] == (True, 1) and got["e"][0] is False


class Service:
    def __init__(self, options):
        self.rows = [{"id": i, "name": f"n{i}"} for i in range(1201)]

    def count(self):
        return len(self.rows)

    def fields(self):
        return {"id": "bigint", "name": "string"}

    def read(self, names, offset, limit):
        return [{k: r[k] for k in names} for r in self.rows[offset : offset + limit]]


def test_paged_source(spark):
    spark.dataSource.register(paged.PagedSource)
    df = spark.read.format("paged_records").option("client", "tests.test_operators:Service").option("fields", "id, name, secret").load()
    assert df.columns == ["id", "name"] and df.count() == 1201 and df.rdd.getNumPartitions() == 3
    many = spark.createDataFrame([(1, [5, 6, 7])], "k int, ids array<int>")
    names = spark.createDataFrame([(5, "five"), (7, "seven")], "id int, name string")
    assert tuple(paged.many2many(many, "k", "ids", names).first()) == (1, "5|6|7", "five||seven")


def test_incremental_runs_only_new_files(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spark.range(3).write.parquet(src)
    go = lambda: incremental.process_new(spark, src, "id long", ck, out, lambda d: d.withColumn("y", F.col("id") * 2))
    assert go() >= 1 and spark.read.parquet(out).count() == 3
    assert go() == 0
    spark.range(3, 5).write.mode("append").parquet(src)
    go()
    assert sorted(r["y"] for r in spark.read.parquet(out).collect()) == [0, 2, 4, 6, 8]
    now = [0.0]
    window = incremental.RateWindow(2, 100, lambda: now[0])
    window.took(60)
    assert window.wait(50) == 60 and window.wait(40) == 0
    docs = spark.createDataFrame([(1, 10), (2, 99), (3, 10), (4, 10)], "k int, c int")
    assert [r["admitted"] for r in incremental.within_budget(docs, "k", "c", 2, 100, 50).orderBy("k").collect()] == [True, False, True, False]


def test_ranks_without_one_task(spark):
    from tallyloom.operators.ranking import with_running

    rows = spark.range(1000).repartition(7).select("id", (F.col("id") % 10).alias("v"))
    got = with_running(rows, [F.desc("id")], {"s": "v"}).orderBy("rank").collect()
    total = 0
    for i, r in enumerate(got):
        total += r["v"]
        assert (r["id"], r["rank"], r["s"]) == (999 - i, i + 1, total)


def test_table_function(spark):
    from tallyloom.functions import udtf

    udtf.register(spark)
    spark.createDataFrame([("a", OFFER), ("b", None)], "k string, text string").createOrReplaceTempView("offers")
    rows = spark.sql("SELECT k, ordinal, item_no, make FROM offers, LATERAL parse_items(offers.text) ORDER BY ordinal").collect()
    assert [tuple(r) for r in rows] == [("a", 0, "1", "FERROX"), ("a", 1, "2", ""), ("a", 2, "3", "")]


def test_alias_pairs_meet_all_alike_spellings(spark):
    from difflib import SequenceMatcher

    names = ["KIRLOSKAR", "CIRLOSKAR", "GRUNDFOS", "CRUNDFOS", "YASKAWA", "JASKAWA", "OMRON", "PHOENIX"]
    rows = spark.createDataFrame([(x,) for i, x in enumerate(names) for _ in range(20 - i)], "s string")
    got = {(r["alias"], r["canonical"]) for r in suggest.alias_pairs(suggest.ranked_spellings(rows, "s")).collect()}
    like = {(b, a) for i, a in enumerate(names) for b in names[i + 1 :] if SequenceMatcher(None, a, b).ratio() >= 0.75}
    assert got == like and len(like) == 3
