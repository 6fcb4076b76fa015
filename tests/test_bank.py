"""Item bank, backfill, cleaning, examples and page layout."""

from pyspark.sql import functions as F

from tallyloom.operators import backfill, bank, cleaning, examples, layout, lines
from tests.samples import OFFER


def test_bank(spark):
    docs = spark.createDataFrame([("offer.txt", OFFER)], "source_path string, text string")
    items = lines.items_of(lines.parse_documents(docs))
    meta = spark.createDataFrame([("offer.txt", "old.txt", "Email", None, "c", None, None, 0), ("offer.txt", "offer.txt", "Q24W10132R3", "05.06.2025", "c", "7", "100", 1)], "source_path string, source_file string, quotation_number string, quotation_date string, customer string, matched_id string, matched_order_id string, pos int")
    orders = spark.createDataFrame([(100, "won", "2025-01-02 10:00:00", "7"), (101, "lost", None, "8")], "order_id int, order_status string, order_date string, partner_id string")
    got = {(r["data_source"], r["item_no"]): r for r in bank.build(items, meta, orders).collect()}
    assert len(got) == 4
    first, third, only = got[("ATTACHMENT_ITEM", "1")], got[("ATTACHMENT_ITEM", "3")], got[("ERP_ORDER_ONLY", None)]
    assert (first["quotation_key"], first["date"], first["date_source"], first["unit"], first["price_basis"]) == ("Q24W10132R3", "2025-01-02", "ERP_ORDER", "NOS", "REPORTED")
    assert got[("ATTACHMENT_ITEM", "2")]["price_basis"] == "DERIVED_FROM_TOTAL" and "NO_PRICE" in third["review_reasons"]
    assert (only["quotation_key"], only["order_id"], only["review_reasons"]) == ("ORDER::101", "101", ["DATE_MISSING"])
    built = bank.build(items, meta, orders)
    assert bank.reasons_by_quotation(built, bank.review(built)).first()["reasons"] == ["NO_PRICE"]


def test_backfill(spark):
    rows = [("d", "Gas analyser MODEL: D-R 820F DURAG GERMANY with pump", None, None, None), ("d", "Pump MAKE: SEIMENS AG, GERMANY ULTRAMAT 23", None, None, None), ("d", "Valve P/N: AB-123.", "X", "m", None), ("d", "Amtek probe", None, None, None), ("e", "A", "Q", None, None), ("e", "B", "Q", None, None), ("e", "C", "Q", None, None), ("e", "D", "", None, None)]
    df = spark.createDataFrame(rows, "doc string, product_name string, make string, model string, part_number string")
    got = {r["product_name"][:5]: (r["make"], r["model"], r["part_number"]) for r in backfill.backfill(df, "doc").collect()}
    assert got["Gas a"] == ("DURAG GERMANY", "D-R 820F", None)
    assert got["Pump "][0].startswith("SIEMENS AG, GERMANY") and got["Valve"] == ("X", "m", "AB-123") and got["Amtek"][0] == "AMETEK"
    assert got["D"][0] == "Q"


def test_cleaning(spark):
    text = "=== PAGE 1 ===\n\n--- page 2 ---\nﬁrst\x07  line\n\nACME Works – Road 10\nnext"
    row = spark.createDataFrame([(text,)], "t string")
    assert row.select(cleaning.clean_extracted(F.col("t"))).first()[0] == "--- PAGE 2 ---\nfirst line\n\nACME Works – Road 10\nnext"
    assert row.select(cleaning.without_messages(F.lit("a ACME Works-Road IO b"), ["ACME Works - Road 10"])).first()[0] in ("a b", "a ACME Works-Road IO b")


def test_examples(spark):
    df = spark.createDataFrame([(1, "Pump 1,500 and 20", "Pump turbo", 1500.0, 30.0), (2, "Filter 7", "Filter", None, 7.0)], "example int, input string, product_name string, unit_price double, total_price double")
    assert sorted(map(tuple, examples.leaks(df).collect())) == [(1, "NUMBER:total_price", "30.0"), (1, "WORD", "turbo")]
    pairs = spark.createDataFrame([(1, 0, 0, True), (1, 1, None, None), (2, 0, 0, True)], "k int, expected_pos int, found_pos int, same boolean")
    scores = {r["k"]: (r["precision"], r["recall"], r["all_right"]) for r in examples.accuracy(pairs, "k", "same").collect()}
    assert scores == {1: (1.0, 0.5, False), 2: (1.0, 1.0, True)}
    assert examples.means(examples.accuracy(pairs, "k", "same")).first()["document_accuracy"] == 0.5


def test_headers_and_rulings():
    rows = [["OFFER", "", ""], ["SR", "Item Description", "Unit"], ["NO.", "", "Price"], ["1", "Pump", "1,500"]]
    assert layout.find_header_window(rows) == (1, 2, {0: "item_no", 1: "description", 2: "unit_price"})
    assert layout.find_header_window([["a", "b"]]) is None
    wide, short = (0, 50, 100, 50.4), [(0, 80, 20, 80), (60, 80, 90, 80)]
    assert layout.ruling_lines([wide, (0, 51, 100, 51), *short], 0, 100) == [50.2]
    band = layout.Band("description", 10, 50)
    assert layout.ruling_lines([(10, y, 50, y) for y in (10, 30, 50)], 0, 100, band) == [10, 30, 50]
    assert layout.ruling_lines([(10, 10, 50, 10)], 0, 100, band) == []
    assert layout.continues([band], [layout.Band("description", 12, 49)], 1) and not layout.continues([band], [band], 2)
    assert layout.merge_bare_rows([{"item_no": "1", "description": "a"}, {"description": "b"}, {"item_no": "2"}]) == [{"item_no": "1", "description": "a\nb"}, {"item_no": "2"}]
    assert layout.spanned_cells([10, 20], 10) == [False, True]
