"""Row checks that give codes and never drop a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions import money
from tallyloom.functions.ids import item_number_ok


def _codes(*pairs: tuple[Column, str | Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(code) if isinstance(code, str) else code) for test, code in pairs]))


def review_reasons(date: Column, raw_dates: Column, ambiguous: Column, customer: Column, is_item: Column, unit: Column, total: Column, confidence: Column, description: Column) -> Column:
    """Reasons why an item or order row deserves a look.  A price of 0 counts as none here."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit("")) == ""
    has_price = (F.coalesce(unit, F.lit(0.0)) != 0) | (F.coalesce(total, F.lit(0.0)) != 0)
    return _codes(
        (blank(date) & ~blank(raw_dates), "DATE_UNPARSEABLE"),
        (blank(date) & blank(raw_dates), "DATE_MISSING"),
        (ambiguous, "DATE_AMBIGUOUS_DAY_MONTH"),
        (blank(customer), "NO_MATCHED_CUSTOMER"),
        (is_item & has_price & (confidence == "LOW"), "LOW_CONFIDENCE_ITEM_WITH_PRICE"),
        (is_item & has_price & blank(description), "PRICE_WITHOUT_DESCRIPTION"),
        (is_item & ~has_price, "NO_PRICE"),
        (is_item & ((unit < 0) | (total < 0)), "IMPLAUSIBLE_NEGATIVE_PRICE"),
    )


def number_tokens(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(r"([\d,]+(?:\.\d+)?)"), 1), lambda x: F.replace(x, F.lit(","), F.lit("")))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")


def is_verbatim(value: Column, raw: Column) -> Column:
    """Whether a value's digits occur among those of the raw text (true for a value without digits)."""
    d = digits_only(value)
    return (d == "") | digits_only(raw).contains(d)


def row_codes(item_no: Column, quantity: Column, unit_word: Column, unit: Column, total: Column, unit_raw: Column, total_raw: Column, raw: Column, derived: Column) -> Column:
    """Validation codes of an item row in fixed order; derived totals are exempt from the first and third."""
    u, t = money.parse_price(F.coalesce(unit_raw, F.lit(""))), money.parse_price(F.coalesce(total_raw, F.lit("")))
    bad = lambda p, r: (F.coalesce(r, F.lit("")) != "") & (p["status"] == "MISSING") & ~p["is_placeholder"]
    none = unit.isNull() & total.isNull()
    return _codes(
        (unit.isNotNull() & ~is_verbatim(unit_raw, raw), "NOT_VERBATIM_IN_RAW_TEXT:unit_price"),
        (total.isNotNull() & ~derived & ~is_verbatim(total_raw, raw), "NOT_VERBATIM_IN_RAW_TEXT:total_price"),
        (~money.arithmetic_ok(quantity, unit, total), "PRICE_ARITHMETIC_MISMATCH"),
        (bad(u, unit_raw), "INVALID_PRICE_FORM:unit_price"),
        (bad(t, total_raw) & ~derived, "INVALID_PRICE_FORM:total_price"),
        (none & (bad(u, unit_raw) | bad(t, total_raw)), "PRICE_PARSE_FAILURE"),
        (none & ~bad(u, unit_raw) & ~bad(t, total_raw) & ~u["is_placeholder"] & ~t["is_placeholder"], "PRICE_ABSENT"),
        (quantity.isNotNull() & (F.coalesce(unit_word, F.lit("")) == ""), "QUANTITY_MISSING_UNIT"),
        (~money.unit_price_ok(unit), "PRICE_OUT_OF_RANGE:unit_price"),
        (~money.total_price_ok(total), "PRICE_OUT_OF_RANGE:total_price"),
        ((F.coalesce(item_no, F.lit("")) != "") & ~item_number_ok(item_no), "ITEM_NO_MALFORMED"),
    )
