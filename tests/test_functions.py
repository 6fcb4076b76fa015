"""Scalar functions on literal inputs."""

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import checks, dates, ids, makes, money, similarity
from tallyloom.functions import text as T
from tallyloom.operators import canonical


def values(spark, inputs, f):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_prices(spark):
    cases = {
        "45,00,000/-": (4500000, "INR", "NUMERIC"), "9,75,000.00": (975000, "INR", "NUMERIC"), "4,500,000": (4500000, "INR", "NUMERIC"), "Rs 65,00,000": (6500000, "INR", "NUMERIC"),
        "93 Lakhs": (9300000, "INR", "NUMERIC"), "1 Lakh": (100000, "INR", "NUMERIC"), "2.5 Cr": (25000000, "INR", "NUMERIC"), "2,70,04,00": (2700400, "INR", "NUMERIC"), "$1,500": (1500, "USD", "NUMERIC"), "SAR 45,000": (45000, "SAR", "NUMERIC"),
        "93": (93, "INR", "NUMERIC"), "CAPACITY) QTY-2": (None, None, "MISSING"), "Power Supply: 230 VAC, 50 Hz": (None, None, "MISSING"), "-64": (None, None, "MISSING"),
        "To be Quoted": (None, None, "QUOTED"), "TBQ": (None, None, "QUOTED"), "Price on Request": (None, None, "QUOTED"), "Incl.": (None, None, "INCLUDED"), "Part of above": (None, None, "INCLUDED"), "Not Quoted": (None, None, "MISSING"), "": (None, None, "MISSING"),
    }
    got = values(spark, list(cases), money.parse_price)
    assert [(r["value"], r["currency"], r["status"]) for r in got] == list(cases.values())
    assert [r["is_placeholder"] for r in values(spark, ["Existing", "TBD", "Not Quoted", "12", ""], money.parse_price)] == [True, True, True, False, False]


def test_numbers(spark):
    assert values(spark, ["16,00,000/-", "Rs. 4,17,000", "Rs 4,17,000", "CAPACITY) QTY-2", "none"], money.permissive_number) == [1600000, 0.417, 417000, -2, None]
    assert values(spark, [" 1,500 ", "nan", "", "1.0d", "2e3"], money.to_number) == [1500, None, None, None, 2000]
    nums = spark.createDataFrame([(2.0,), (2.5,), (1.23456,), (None,)], "x double")
    assert [r[0] for r in nums.select(money.format_number(F.col("x"))).collect()] == ["2", "2.5", "1.2346", ""]
    assert values(spark, ["450 Meters", "2", "1 Set", "10 Man-days", "3 dogs"], lambda c: money.parse_quantity(c)["value"]) == [450, None, 1, 10, None]
    assert values(spark, ["Nos.", "Sq.m", "Furlong", ""], money.normalize_unit) == ["NOS", "SQM", "FURLONG", ""]
    assert values(spark, ["NOS", "SET", "FURLONG", ""], money.unit_class) == ["COUNT", "BUNDLE", "", ""]


@pytest.mark.parametrize("unit,total,quantity,want", [(100, None, 5, (100, 500, "DERIVED_FROM_UNIT")), (None, 500, 5, (100, 500, "DERIVED_FROM_TOTAL")), (None, 500, 0, (None, 500, "REPORTED")), (None, None, None, (None, None, "NONE"))])
def test_resolved_prices(spark, unit, total, quantity, want):
    row = spark.createDataFrame([tuple(None if x is None else float(x) for x in (unit, total, quantity))], "u double, t double, q double").select(money.resolve_prices(F.col("u"), F.col("t"), F.col("q")).alias("r")).first()["r"]
    assert tuple(row) == want


def test_dates(spark):
    cases = {"05.06.2025": ("2025-06-05", True), "25.06.2025": ("2025-06-25", False), "6/25/2025": ("2025-06-25", False), "2025/07/09": ("2025-07-09", False), "17 Augest 24": ("2024-08-17", False), "31.02.2025": ("", False), "24-25/1264": ("", False), "05.05.2025": ("2025-05-05", True), "1.1.1999": ("", False), "": ("", False)}
    assert [tuple(r) for r in values(spark, list(cases), dates.parse_document_date)] == list(cases.values())
    assert values(spark, ["2025-06-05 09:12:31", "x", None], dates.parse_export_date) == ["2025-06-05", "", ""]


def test_identifiers(spark):
    assert values(spark, [" q24 akic 10077 ", None], ids.request_number) == ["Q24AKIC10077", ""]
    assert values(spark, ["Q24W10132R3", "Q24W10132"], ids.base_number) == ["Q24W10132", ""]
    levels = [tuple(r) for r in values(spark, ["1", "1.1", "1.1.2", "4a", "12 B", "2.", "3)", ""], ids.item_hierarchy)]
    assert levels == [("", 1), ("1", 2), ("1.1", 3), ("4", 2), ("12", 2), ("", 1), ("", 1), ("", 0)]
    pairs = spark.createDataFrame([("Q24W10136", "Q24W10132R3"), ("Q1X", "R1"), ("Q1X", "PO Booking Mail"), ("Q1X", "")], "a string, b string")
    assert [tuple(r[0]) for r in pairs.select(ids.manifest_number(F.col("a"), F.col("b"))).collect()] == [("Q24W10132R3", False), ("Q1XR1", False), ("Q1X", True), ("Q1X", False)]
    keys = spark.createDataFrame([("Email", "a.txt", None), ("R1", None, "7"), ("q24akic10077", None, None), (None, None, None)], "n string, f string, o string")
    assert [tuple(r[0]) for r in keys.select(ids.quotation_key(F.col("n"), F.col("f"), F.col("o"))).collect()] == [("DOC::a.txt", "DOCUMENT_FALLBACK"), ("ORDER::7", "ORDER_FALLBACK"), ("Q24AKIC10077", "QUOTATION_NUMBER"), ("", "NONE")]


def test_makes(spark):
    cases = {"SIEMENS AG, GERMANY": ["SIEMENS"], "HP/LENOVO/EQUIVALENT": ["HP", "LENOVO"], "ENDRESS HAUSER OR EQUIVALENT": ["ENDRESS HAUSER"], "ROTORK": ["ROTORK"], "USA": ["USA"], "": []}
    assert values(spark, list(cases), makes.make_parts) == list(cases.values())
    pairs = [("MAXUM ED II", "MAXUM EDITION II", True), ("THERMO", "THERMON", False), ("SMARTPRO 8967EX", "SMARTPRO 8967", False), ("SITRANS F", "SITRANS FM", False), ("A B", "A B", False)]
    df = spark.createDataFrame(pairs, "a string, b string, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", makes.abbreviates(F.col("a"), F.col("b"))).collect())
    df = spark.createDataFrame([("AIROPTICS", "AIROPTIC", True), ("ABBS", "ABB", False)], "a string, b string, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", makes.plural_of(F.col("a"), F.col("b"))).collect())
    assert values(spark, ["VALMET(SIEMENS", "SIEMENS [SICK", "A (B)"], makes.is_truncated) == [True, True, False]
    rows = spark.createDataFrame([(1, "AMETEK/MICHELL INSTRUMENTS"), (2, "AIROPTIC"), (3, "AIROPTIC"), (4, "AIR OPTIC"), (5, "SIEMENS AG")], "k int, make string")
    alias = spark.createDataFrame([("Michell Instruments", "MICHELL")], "alias string, canonical string")
    got = {r["k"]: (r["canonical"], r["basis"]) for r in canonical.canonical_makes(rows, "k", "make", alias).collect()}
    assert got == {1: ("AMETEK|MICHELL", "ALIAS"), 2: ("AIROPTIC", "COSMETIC"), 3: ("AIROPTIC", "COSMETIC"), 4: ("AIROPTIC", "RULE"), 5: ("SIEMENS", "RULE")}


def test_text(spark):
    assert values(spark, ["--- PAGE 1 ---\nx", "x", " "], T.page_count) == [2, 1, 0]
    assert values(spark, ["straße café x_1", ""], T.word_count) == [3, 0]
    assert values(spark, ["a\r\n\r\n\r\n\r\nb\t  c "], T.clean_text) == ["a\n\nb c"]
    assert values(spark, ["Pump\nService: water", "with valve and seat", "w " * 40, "A\n• b"], T.heading) == ["Pump", "with valve and seat", " ".join("w" * 15) + "...", "A"]
    assert values(spark, ["A & B: (x)*"], T.normalize_label) == ["a and b (x)"]
    assert values(spark, ["UNIT PRICE (INR)"], T.normalize_header_cell) == ["unit price"]
    words = spark.createDataFrame([(["a", "b", "c"],), (["a"],)], "w array<string>")
    assert [r[0] for r in words.select(T.ngrams(F.col("w"), 2)).collect()] == [["a b", "b c"], []]
    assert values(spark, ["x" * 120 + " ok", "", "short"], T.document_status) == ["WARNING", "EMPTY", "WARNING"]


def test_names(spark):
    rows = spark.createDataFrame([("M/s. ABC Industries Pvt. Ltd.", "ABC Industries Private Limited"), ("abc corp", "abc corporation"), ("", "x"), ("Blue Works", "Blue Work")], "a string, b string")
    norm = [similarity.normalize_name(F.col(c)) for c in ("a", "b")]
    got = [r[0] for r in rows.select(similarity.similarity(*norm)).collect()]
    assert got[0] == 1.0 and got[1] != 1.0 and got[2] == 0.0 and 0.5 < got[3] < 1
    fixed = [similarity.normalize_name(F.col(c), token_wise=True) for c in ("a", "b")]
    assert rows.where("a = 'abc corp'").select(fixed[0] == fixed[1]).first()[0]


def test_price_quality(spark):
    rows = spark.createDataFrame([("REPORTED", "NUMERIC", ""), ("REPORTED", "NUMERIC", "PRICE_ABSENT"), ("NONE", "QUOTED_SEPARATELY", ""), ("NONE", "MISSING", "")], "b string, s string, e string")
    assert [r[0] for r in rows.select(money.price_quality(F.col("b"), F.col("s"), F.col("e"))).collect()] == ["TRUSTED", "FLAGGED", "NON_NUMERIC", "NO_PRICE"]
    assert values(spark, ["12 and 3,400.5"], checks.number_tokens) == [["12", "3400.5"]]
