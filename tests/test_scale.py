"""Work done once: what made queries too slow on larger tables."""

from pyspark.sql import functions as F

from tallyloom.functions import dates
from tallyloom.operators import bank, layout, lines
from tallyloom.plans import fixtures
from tests.samples import OFFER


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_review_reads_documents_once(spark):
    odd = "Quotation No: Q1\nDescription\nRate\n1\nPump\n5 Nos\n1,900"
    docs = spark.createDataFrame([("a", OFFER), ("b", odd), ("c", ""), ("d", None)], "source_path string, text string")
    whole = lines.review_of(lines.parse_documents(docs))
    assert _plan(whole).count("MapInArrow") == 1
    pruned = lines.review_of(lines.parse_documents(docs, only=lines.REVIEWED, item_fields=lines.REVIEWED_ITEM))
    missing = [(p, "document", f"{x}_MISSING") for p in "bcd" for x in (("CUSTOMER", "SUBJECT") if p == "b" else ("CUSTOMER", "SUBJECT", "TABLE"))]
    want = [("a", "document", "ITEM_3_NO_PRICE_VALUES"), ("a", "item", "ITEM_CONFIDENCE_LOW"), ("b", "document", "ITEM_1_ONLY_ONE_VALUE"), ("b", "item", "ITEM_CONFIDENCE_MEDIUM"), *missing]
    assert sorted(map(tuple, whole.collect())) == sorted(want) == sorted(map(tuple, pruned.collect()))
    failed = lines.parse_documents(docs.where("source_path = 'a'")).withColumns({"error": F.lit("PARSER_ERROR: x"), "customer": F.lit(None).cast("string"), "items": F.expr("filter(items, x -> false)"), "warnings": F.expr("filter(warnings, x -> false)")})
    assert [tuple(r) for r in lines.review_of(failed).collect()] == [("a", "document", "PARSER_ERROR: x")]


def test_reader_finds_a_lines_facts_once(spark):
    reader, learned = lines.Reader(only=["items"]), []
    line, cell = reader.line, reader.cell
    reader.line, reader.cell = lambda x: learned.append(x) or line(x), lambda x: learned.append(x) or cell(x)
    first, looked = reader.document(OFFER.splitlines()), len(learned)
    again = [reader.document(OFFER.splitlines()) for _ in range(5)]
    assert all(x["items"] == first["items"] for x in again) and all(set(x) <= set("0123456789,") for x in learned[looked:])
    docs = spark.createDataFrame([("a", OFFER)], "source_path string, text string")
    made = lines.items_of(lines.parse_documents(docs, only=["items"], item_fields=["item_no", "make", "total_price"]))
    assert [tuple(r) for r in made.collect()] == [("a", 0, "1", "FERROX", 20000.0), ("a", 1, "2", "", 5500.0), ("a", 2, "3", "", None)]


def test_document_fields_alone_build_no_items(spark, monkeypatch):
    wanted = ["customer", "subject", "quotation_number", "boq_detected", "document_confidence"]
    reader = lines.Reader(only=wanted)
    monkeypatch.setattr(reader, "item", lambda *_: 1 / 0)
    assert {k: reader.document(OFFER.splitlines())[k] for k in wanted} == {k: lines.parse_lines(OFFER.splitlines())[k] for k in wanted}
    docs = spark.createDataFrame([("a", OFFER), ("b", None)], "source_path string, text string")
    assert [tuple(r) for r in lines.parse_documents(docs, only=wanted).orderBy("source_path").collect()] == [("a", "Blue Harbour Works", "Offer for analysers", "Q24W10132R3", True, "HIGH"), ("b", "", "", "", False, "LOW")]


def test_bank_reads_dates_once_for_each_document(spark):
    docs = spark.createDataFrame([("a", "a", "Q24W10132R3", "05.06.2025", "c", "7", "1", 0), ("b", "b", "-", "31.06.2025", "c", "7", "3", 0)], "source_path string, source_file string, quotation_number string, quotation_date string, customer string, matched_id string, matched_order_id string, pos int")
    orders = spark.createDataFrame([(1, "won", None, "7"), (2, "won", "2025-13-01", "7"), (3, "won", "2025-01-02", "8")], "order_id int, order_status string, order_date string, partner_id string")
    items = lines.items_of(lines.parse_documents(spark.createDataFrame([("a", OFFER), ("b", OFFER), ("z", OFFER)], "source_path string, text string"))).where("item_no = '1'")
    built = bank.build(items, docs, orders)
    got = {(r["source_path"], r["order_id"], r["reason"]) for r in bank.review(built).collect()}
    assert got == {("a", "1", "DATE_AMBIGUOUS_DAY_MONTH"), ("z", None, "DATE_MISSING"), ("z", None, "NO_MATCHED_CUSTOMER"), (None, "2", "DATE_UNPARSEABLE")}
    assert _plan(bank.review(built)).count(dates.WORDED) <= 12  # one reading for documents, one for orders, one for items without a document


def test_pages_are_cut_from_batches(spark):
    words = [(p, x, 100.0 + 20 * i, x + 5 * len(t), 108.0 + 20 * i, t) for p, n in ((1, 2), (2, 5), (None, 3), (4, 1), (5, 4)) for i in range(n) for x, t in ((0.0, str(i + 1)), (60.0, "Pump"), (260.0, f"{i + 1},500"))]
    df = spark.createDataFrame(words, "page long, x0 double, y0 double, x1 double, y1 double, text string")
    assert "InPandas" not in _plan(layout.layout_rows(df))
    want = [(p, s + 1, r["item_no"], r["description"], r["unit_price"]) for p in (1, 2, None, 4, 5) for s, r in enumerate(layout.rows_of_page([layout.Word(*w[1:]) for w in words if w[0] == p]))]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("1", "7", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = layout.layout_rows(df).select("page", "row_seq", "item_no", "description", "unit_price").collect()
            assert len(want) == 14 and sorted(map(tuple, got), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_items_with_like_lines_are_planned_once(spark, monkeypatch):
    reader, planned = lines.Reader(only=["items"]), []
    plan = reader.plan
    monkeypatch.setattr(reader, "plan", lambda *a: planned.append(a) or plan(*a))
    first = reader.document(OFFER.splitlines())["items"]
    assert len(planned) == 3  # the second holds a note, so it is read whole each time
    priced = reader.document(OFFER.replace("Gas analyser", "Flow meter").replace("10,000", "70,500").replace("20,000", "141,000").replace("FERROX", "NORDIK").splitlines())["items"]
    assert len(planned) == 4 and (priced[0].description, priced[0].unit_price, priced[0].total_price, priced[0].fields) == ("Flow meter", 70500.0, 141000.0, {"make": "NORDIK", "model": "GX 20"})
    assert first[0].unit_price == 10000.0 and first[0].fields == {"make": "FERROX", "model": "GX 20"}
    # lines that look alike but have another part: a field whose value is on the next line, a text before a field
    head, tail = "Description\nRate\n1\n", "\n9,000\n18,000"
    odd = {"Pump\nMake:\nFERROX\n2 Nos": ("Pump", "FERROX", "Nos"), "Pump\nMake: Q\nFERROX\n2 Nos": ("Pump\nFERROX", "Q", "Nos"), "Pump Make: Q\n2 Nos": ("Pump", "Q", "Nos")}
    for text, want in [*odd.items(), *odd.items()]:
        item = reader.document((head + text + tail).splitlines())["items"][0]
        assert (item.description, item.fields.get("make"), item.unit) == want and (item.unit_price, item.total_price) == (9000.0, 18000.0)
    docs = spark.createDataFrame([("a", OFFER), ("b", None), ("c", head + "Pump" + tail)], "source_path string, text string")
    rows = lines.parse_items(docs)
    assert "Generate" not in _plan(rows) and len(want := lines.items_of(lines.parse_documents(docs, only=["items"])).collect()) == 4 and sorted(map(tuple, rows.collect())) == sorted(map(tuple, want))


def test_offers_are_ordered_without_an_interpreted_comparison(spark):
    plan = _plan(fixtures.offers(spark, "/root/testdata/sf0.001"))
    assert "sort_array(" in plan and "array_sort(" not in plan


def test_the_first_item_settles_that_a_table_has_items(monkeypatch):
    reader, looked = lines.Reader(only=["document_confidence"]), []
    cell = reader.cell
    monkeypatch.setattr(reader, "cell", lambda x: looked.append(x) or cell(x))
    assert reader.document(OFFER.splitlines())["document_confidence"] == "HIGH" and looked == ["Qty", "Unit Price", "Total Price", "1", "Gas analyser"]
    noted = "Description\nRate\nNote:\n1. a\n2.\n"
    assert [lines.Reader(only=["document_confidence"]).document((noted + x).splitlines())["document_confidence"] for x in ("", "1\nPump")] == ["LOW", "MEDIUM"]


def test_lines_of_one_shape_are_read_once(monkeypatch):
    def offer(n, date, amount, buyer="Works Customer"):
        return f"Quotation No: Q24W{n:08}R1 dated today\nDate: {date}\nTo:\nKind Attention: Mr. A. Sample {n}\n{buyer} {n:09}\nSubject: Offer  for order {n}\nDescription\nRate\n1\nPump\n5 Nos\n{n:,}\nGrand Total {amount}".splitlines()

    reader, learned, skipped = lines.Reader(only=lines.FIELDS), [], []
    line, skippable = reader.line, reader.skippable
    monkeypatch.setattr(reader, "line", lambda x: learned.append(x) or line(x))
    reader.document(offer(1234, "05.06.2025", "1,900.50"))
    looked = len(learned)
    monkeypatch.setattr(reader, "skippable", lambda x, k: skipped.append(x) or skippable(x, k))
    for n, date, amount, want in ((5678, "17.08.2024", "2,345.75", 2345.75), (9999, "30.11.2023", "9,999.99", 9999.99)):
        got = reader.document(offer(n, date, amount))
        assert (got["quotation_number"], got["quotation_date"], got["customer"], got["grand_total"]) == (f"Q24W{n:08}R1", date, f"Works Customer {n:09}", want)
        assert got["subject"] == f"Offer for order {n}"  # other blanks than on its line
        assert (got["items"][0].description, got["items"][0].total_price) == ("Pump", n)
    assert len(learned) == looked and all(x.startswith("Offer") for x in skipped)
    # another length is another shape; only ASCII digits are alike
    assert reader.document(["Total: 7"])["grand_total"] is None and reader.document(["Grand Total: 71"])["grand_total"] == 71 and reader.document(["Grand Total: ٣"])["grand_total"] == 3
    # labels with digits see which digit it is
    own = lines.Reader(number_labels=["form 7 no", "ref"], only=["quotation_number"])
    assert [own.document([x])["quotation_number"] for x in ("form 7 no: Q5", "form 8 no: Q5", "ref: Q6")] == ["Q5", "", "Q6"]
