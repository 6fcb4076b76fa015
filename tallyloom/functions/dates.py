"""Dates as printed on documents, and from exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import let, normalize_spaces

FIRST_YEAR, LAST_YEAR = 2015, 2027
#: Spellings of months, one a common misspelling.
MONTHS = {1: ["jan", "january"], 2: ["feb", "february"], 3: ["mar", "march"], 4: ["apr", "april"], 5: ["may"], 6: ["jun", "june"], 7: ["jul", "july"], 8: ["aug", "august", "augest"], 9: ["sep", "sept", "september"], 10: ["oct", "october"], 11: ["nov", "november"], 12: ["dec", "december"]}
NUMERIC = r"^(\d{1,4})[./-](\d{1,2})[./-](\d{2,4})$"
WORDED = r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{2,4})$"


def _iso(year: Column, month: Column, day: Column) -> Column:
    """ISO text of a real date inside the window, else null."""
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    fits = year.between(FIRST_YEAR, LAST_YEAR) & month.between(1, 12) & day.between(1, 31)
    return F.when(fits & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), text)


def _full_year(y: Column) -> Column:
    return F.when(y >= 100, y).otherwise(y + 2000)


def parse_document_date(c: Column) -> Column:
    """Struct (date: ISO text or blank, ambiguous): day first where both readings are dates, and then marked."""
    names = F.create_map(*[F.lit(x) for m, spellings in MONTHS.items() for t in spellings for x in (t, m)])

    def read(s: Column) -> Column:
        part = lambda pattern, i: F.regexp_extract(s, pattern, i)
        month = F.try_element_at(names, F.lower(part(WORDED, 2)))
        worded = F.struct(F.lit(True).alias("worded"), part(WORDED, 1).try_cast("int").alias("a"), month.alias("b"), part(WORDED, 3).try_cast("int").alias("c"))
        numeric = F.struct(F.lit(False).alias("worded"), *[part(NUMERIC, i + 1).try_cast("int").alias(x) for i, x in enumerate("abc")])
        return let(F.when(s.rlike(WORDED), worded).otherwise(numeric), told)

    def told(x: Column) -> Column:
        """Both readings of the three numbers; a worded month and a leading year leave one."""
        year_first = ~x["worded"] & (x["a"] >= 1000)
        day_first = F.when(year_first, _iso(x["a"], x["b"], x["c"])).otherwise(_iso(_full_year(x["c"]), x["b"], x["a"]))
        month_first = F.when(~x["worded"] & (x["a"] < 1000), _iso(_full_year(x["c"]), x["a"], x["b"]))
        found = F.struct(day_first.alias("d"), month_first.alias("m"))
        return let(found, lambda y: F.struct(F.coalesce(y["d"], y["m"], F.lit("")).alias("date"), (y["d"].isNotNull() & y["m"].isNotNull()).alias("ambiguous")))

    return let(normalize_spaces(F.coalesce(c, F.lit(""))), read)


def parse_export_date(c: Column) -> Column:
    """The leading ISO date inside the window, or blank."""
    head = F.regexp_extract(F.coalesce(c, F.lit("")), r"^\s*(\d{4}-\d{2}-\d{2})", 1)
    part = lambda i, n: F.substring(head, i, n).try_cast("int")
    return F.coalesce(_iso(part(1, 4), part(6, 2), part(9, 2)), F.lit(""))


def resolve_date(export: Column, document: Column) -> Column:
    """Struct (date, source, ambiguous, year, month): the export's date counts before the document's."""

    def told(x: Column) -> Column:
        date = F.when(x["e"] != "", x["e"]).otherwise(x["d"]["date"])
        return F.struct(
            date.alias("date"),
            F.when(x["e"] != "", "ERP_ORDER").when(x["d"]["date"] != "", "PARSED_DOC").otherwise("NONE").alias("source"),
            ((x["e"] == "") & x["d"]["ambiguous"]).alias("ambiguous"),
            F.substring(date, 1, 4).alias("year"),
            F.substring(date, 1, 7).alias("month"),
        )

    # each text is read once, the document's only where the export gives no date
    return let(parse_export_date(export), lambda e: let(F.struct(e.alias("e"), F.when(e == "", parse_document_date(document)).alias("d")), told))
