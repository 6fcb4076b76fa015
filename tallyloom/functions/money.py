"""Money, quantities, units and derived prices as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import normalize_spaces, normalize_text_value, strip
from tallyloom.functions.units import UNIT_WORDS, WORK_WORDS, any_of

#: Currency marks, the words that scale a number, and what stands for a price.
RUPEE_MARKS = ["₹", "Rs.", "Rs", "INR"]
OTHER_MARKS = ["USD", "$", "SAR", "€", "£"]
LAKH, CRORE = ["lakh", "lac"], ["crore", "cr"]
QUOTED_WORDS = ["quoted", "to be quoted", "tbq", "price on request"]
INCLUDED_WORDS = ["included", "inclusive", "incl", "bundled", "part of above"]
DENIED_WORDS = ["quoted", "included", "inclusive"]
PRICE_ENDS = ["/-", "/="]

CURRENCY = any_of(RUPEE_MARKS + OTHER_MARKS)
NUMBER = r"\d{1,3}(?:,\d{1,3})+|\d+"
MONEY = rf"(?i)^\s*({CURRENCY})?\s*({NUMBER})(?:\.(\d{{1,2}}))?\s*{any_of(PRICE_ENDS)}?\s*({CURRENCY})?\s*$"
SCALED = rf"(?i)^\s*{any_of(RUPEE_MARKS)}?\s*(\d+(?:\.\d+)?)\s*({'|'.join(LAKH + CRORE)})s?\.?\s*$"
NEGATED = rf"(?i)\bnot\s+{any_of(DENIED_WORDS)}\b"
QUOTED, INCLUDED = (rf"(?i)\b{any_of(words)}\b" for words in (QUOTED_WORDS, INCLUDED_WORDS))
#: Cells that stand for a missing price.
SENTINELS = ["quoted", "included", "inclusive", "not quoted", "existing", "not used in a system", "tbd", "ls", "as per actual", "na", "n/a"]
UNIT_WORD = rf"(?i)^{any_of(UNIT_WORDS + WORK_WORDS)}$"
#: Spellings of each unit.
UNIT_SPELLINGS = {
    "NOS": ["NO", "NOS", "NUMBER", "NUMBERS"],
    "PCS": ["PC", "PCS", "PIECE", "PIECES"],
    "SET": ["SET", "SETS"],
    "JOB": ["JOB", "JOBS"],
    "LOT": ["LOT", "LOTS"],
    "UNIT": ["UNIT", "UNITS"],
    "EACH": ["EA", "EACH"],
    "KG": ["KG", "KGS"],
    "GRAM": ["GRAM", "GRAMS"],
    "MG": ["MG"],
    "TON": ["TON", "TONS"],
    "LTR": ["L", "LTR", "LTRS", "LITER", "LITERS", "LITRE", "LITRES"],
    "METER": ["M", "MTR", "MTRS", "METER", "METERS", "METRE", "METRES"],
    "MM": ["MM"],
    "CM": ["CM"],
    "KM": ["KM"],
    "SQM": ["SQM", "SQ M"],
    "SQFT": ["SQFT", "SQ FT"],
    "HOUR": ["HOUR", "HOURS", "HR", "HRS"],
    "DAY": ["DAY", "DAYS"],
    "MONTH": ["MONTH", "MONTHS"],
    "YEAR": ["YEAR", "YEARS"],
}
#: What each unit measures.
UNIT_CLASSES = {
    "COUNT": ["NOS", "PCS", "EACH", "UNIT"],
    "BUNDLE": ["SET", "LOT", "JOB"],
    "LENGTH": ["METER", "MM", "CM", "KM"],
    "TIME": ["HOUR", "DAY", "MONTH", "YEAR"],
    "MASS": ["KG", "GRAM", "MG", "TON"],
    "VOLUME": ["LTR"],
    "AREA": ["SQM", "SQFT"],
}


def to_number(c: Column) -> Column:
    """A number without commas; blank, ``nan``, ``none`` and anything else: null."""
    s = F.replace(strip(c), F.lit(","), F.lit(""))
    return F.when(s.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"), s.try_cast("double"))


def format_number(x: Column) -> Column:
    """Whole numbers without a point, others at four decimals; null: blank."""
    whole = x == F.floor(x)
    return F.when(x.isNull(), "").when(whole & (F.abs(x) < 1e15), x.cast("long").cast("string")).otherwise(F.bround(x.cast("decimal(28,10)"), 4).cast("double").cast("string"))


def permissive_number(c: Column) -> Column:
    """Everything but digits, comma, point and minus dropped, then read: prose may become a number (kept for parity)."""
    s = F.regexp_replace(strip(c), r"/-\s*$", "")
    s = F.replace(F.regexp_replace(s, r"[^0-9,.\-]", ""), F.lit(","), F.lit(""))
    return F.when(s.rlike(r"^-?(\d+\.?\d*|\.\d+)$"), s.try_cast("double"))


def first_number(c: Column) -> Column:
    found = F.regexp_extract(c, r"[-+]?\d[\d,]*(?:\.\d+)?", 0)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("double")


def parse_price(c: Column) -> Column:
    """Struct (value, currency, status, is_placeholder) of a price cell: the whole cell has to be money, never a part of prose."""
    s = strip(c)
    negated = s.rlike(NEGATED)
    quoted, included = ~negated & s.rlike(QUOTED), ~negated & s.rlike(INCLUDED)
    sentinel = F.lower(s).isin(*SENTINELS)
    scale = F.lower(F.regexp_extract(s, SCALED, 2))
    scaled = F.regexp_extract(s, SCALED, 1).try_cast("double") * F.when(scale.isin(*LAKH), 100_000.0).otherwise(10_000_000.0)
    decimals = F.regexp_extract(s, MONEY, 3)
    digits = F.replace(F.regexp_extract(s, MONEY, 2), F.lit(","), F.lit(""))
    plain = F.when(digits != "", F.concat(digits, F.lit("."), F.when(decimals == "", "0").otherwise(decimals))).try_cast("double")
    sign = F.upper(F.regexp_extract(s, MONEY, 1))
    sign = F.replace(F.when(sign != "", sign).otherwise(F.upper(F.regexp_extract(s, MONEY, 4))), F.lit("."), F.lit(""))
    currency = F.when(sign.isin("USD", "$"), "USD").when(sign == "SAR", "SAR").when(sign.isin("€", "EUR"), "EUR").when(sign.isin("£", "GBP"), "GBP").otherwise("INR")
    word = quoted | included | sentinel
    is_scaled, is_plain = s.rlike(SCALED), s.rlike(MONEY)
    value = F.when((s == "") | word, F.lit(None).cast("double")).when(is_scaled, scaled).when(is_plain, plain)
    return F.struct(
        value.alias("value"),
        F.when((s == "") | word, F.lit(None).cast("string")).when(is_scaled, "INR").when(is_plain, currency).alias("currency"),
        F.when(s == "", "MISSING").when(quoted, "QUOTED").when(included, "INCLUDED").when(sentinel, "MISSING").when(is_scaled | is_plain, "NUMERIC").otherwise("MISSING").alias("status"),
        ((s != "") & word).alias("is_placeholder"),
    )


def combined_status(unit: Column, total: Column) -> Column:
    """Status of a row from the statuses of its unit and total price."""
    either = lambda x: (unit == x) | (total == x)
    return F.when(either("NUMERIC"), "NUMERIC").when(either("QUOTED"), "QUOTED_SEPARATELY").when(either("INCLUDED"), "INCLUDED").otherwise("MISSING")


def unit_price_ok(x: Column) -> Column:
    return x.isNull() | x.between(1e3, 5e8)


def total_price_ok(x: Column) -> Column:
    return x.isNull() | x.between(1e3, 5e9)


def parse_quantity(c: Column) -> Column:
    """Struct (value, unit): a number with a known unit word; a bare number is none."""
    pattern = r"^\s*(\d+(?:\.\d+)?)\s*([A-Za-z][A-Za-z.\-]*)\s*$"
    s = strip(c)
    unit = F.regexp_extract(s, pattern, 2)
    ok = F.rtrim(F.regexp_replace(unit, r"\.+$", "")).rlike(UNIT_WORD)
    return F.struct(F.when(ok, F.regexp_extract(s, pattern, 1).try_cast("double")).alias("value"), F.when(ok, unit).alias("unit"))


def quantity_and_unit(quantity: Column, unit: Column) -> Column:
    """As parse_quantity, but a unit cell that is a unit word counts with a bare number beside it."""
    u = strip(F.coalesce(unit, F.lit("")))
    known = (u != "") & F.regexp_replace(u, r"\.+$", "").rlike(UNIT_WORD)
    bare = to_number(quantity)
    one = parse_quantity(quantity)
    return F.struct(F.when(known & bare.isNotNull(), bare).otherwise(one["value"]).alias("value"), F.when(known & bare.isNotNull(), u).otherwise(one["unit"]).alias("unit"))


def _lookup(c: Column, table: dict[str, list[str]], other: Column) -> Column:
    pairs = [F.lit(x) for name, spellings in table.items() for s in spellings for x in (s, name)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), other)


def normalize_unit(c: Column) -> Column:
    """Canonical unit; an unknown one in normal form, blank for blank."""
    text = normalize_text_value(c)
    return _lookup(normalize_spaces(F.replace(text, F.lit("."), F.lit(" "))), UNIT_SPELLINGS, text)


def unit_class(c: Column) -> Column:
    return _lookup(c, UNIT_CLASSES, F.lit(""))


def arithmetic_ok(quantity: Column, unit: Column, total: Column) -> Column:
    """Whether |quantity x unit - total| is at most 1 or 2 % of the total; true if any is missing."""
    missing = quantity.isNull() | unit.isNull() | total.isNull()
    return missing | (F.abs(quantity * unit - total) <= F.greatest(F.lit(1.0), 0.02 * total))


def arithmetic_check(quantity: Column, unit: Column, total: Column) -> Column:
    missing = quantity.isNull() | unit.isNull() | total.isNull()
    return F.when(missing, "").when(arithmetic_ok(quantity, unit, total), "OK").otherwise("MISMATCH")


def resolve_prices(unit: Column, total: Column, quantity: Column) -> Column:
    """Struct (unit, total, basis): the missing one of unit and total price follows from a positive quantity."""
    q = quantity.isNotNull() & (quantity > 0)
    from_unit, from_total = unit.isNotNull() & total.isNull() & q, unit.isNull() & total.isNotNull() & q
    return F.struct(
        F.when(from_total, total / quantity).otherwise(unit).alias("unit"),
        F.when(from_unit, unit * quantity).otherwise(total).alias("total"),
        F.when(unit.isNull() & total.isNull(), "NONE").when(from_unit, "DERIVED_FROM_UNIT").when(from_total, "DERIVED_FROM_TOTAL").otherwise("REPORTED").alias("basis"),
    )


def stated_or_derived_total(total: Column, unit: Column, quantity: Column, spanned: Column) -> Column:
    """Struct (total, source): a stated total counts before quantity x unit; a cell that spans rows gives none."""
    derived = (quantity * unit).cast("double")
    value = F.when(spanned, F.lit(None).cast("double")).when(total.isNotNull(), total).otherwise(derived)
    return F.struct(value.alias("total"), F.when(value.isNull(), "").when(total.isNotNull(), "STATED").otherwise("DERIVED").alias("source"))


def price_quality(basis: Column, status: Column, errors: Column) -> Column:
    flagged = F.coalesce(errors, F.lit("")).contains("PRICE_")
    return F.when(flagged, "FLAGGED").when(basis == "NONE", F.when(status.isin("QUOTED_SEPARATELY", "INCLUDED"), "NON_NUMERIC").otherwise("NO_PRICE")).otherwise("TRUSTED")


def document_currency(text: Column) -> Column:
    """The first currency in this order that the text names; blank if none."""
    u = F.upper(text)
    has = lambda *xs: _any(u, xs)
    return F.when(has("INR", "RS.", "RS ", "₹"), "INR").when(has("USD", "$"), "USD").when(has("EUR", "€"), "EUR").when(has("GBP", "£"), "GBP").otherwise("")


def _any(c: Column, parts) -> Column:
    hit = F.lit(False)
    for p in parts:
        hit = hit | c.contains(p)
    return hit
