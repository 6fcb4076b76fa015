"""The item bank: items with their document, order, date, prices and reasons for review, and orders without a document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import checks, dates, ids, money
from tallyloom.functions import text as T
from tallyloom.operators import joins

COLUMNS = [
    "data_source", "source_path", "source_file", "ordinal", "quotation_number", "quotation_key", "quotation_key_basis", "item_no", "description", "make", "model", "quantity", "unit", "unit_class",
    "unit_price", "total_price", "price_basis", "confidence", "customer", "matched_id", "order_id", "order_status", "date", "date_source", "date_ambiguous", "year", "month", "review_reasons",
]


def build(items: DataFrame, documents: DataFrame, orders: DataFrame) -> DataFrame:
    """Attachment items and order-only rows under COLUMNS.

    ``items``: source_path, ordinal and parsed fields.  ``documents``: source_path (the last of repeated ones by ``pos`` counts), source_file,
    quotation_number, quotation_date, customer, matched_id, matched_order_id, pos.  ``orders``: order_id, order_status, order_date, partner_id.
    An order is order-only if no document is linked to it; links come from documents, so items cannot count one twice.
    """
    known = lambda number, file, order, export, day: {"k": ids.quotation_key(number, file, order), "d": dates.resolve_date(export.cast("string"), day)}
    none = F.lit(None).cast("string")
    keyed = orders.select(F.col("order_id").cast("string").alias("matched_order_id"), "order_status", "order_date").dropDuplicates(["matched_order_id"])
    # dates and keys belong to documents, so they are read before the items multiply them
    read = joins.last_of_each(documents, "source_path", "pos").join(keyed, "matched_order_id", "left")
    read = read.withColumns(known(F.col("quotation_number"), F.col("source_file"), F.col("matched_order_id"), F.col("order_date"), F.col("quotation_date")))
    rows = items.drop("quotation_number").join(read, "source_path", "left").withColumns({c: F.coalesce(F.col(c), x) for c, x in known(none, none, none, none, none).items()})
    rows = rows.withColumn("data_source", F.lit("ATTACHMENT_ITEM")).withColumn("order_id", F.col("matched_order_id"))
    links = documents.where(F.coalesce(F.col("matched_order_id"), F.lit("")) != "")
    rest = joins.unlinked(orders.withColumn("order_id", F.col("order_id").cast("string")), "order_id", links, "matched_order_id")
    rest = rest.select(F.lit("ERP_ORDER_ONLY").alias("data_source"), "order_id", "order_status", "order_date", F.col("partner_id").alias("matched_id")).withColumns(known(none, none, F.col("order_id"), F.col("order_date"), none))
    both = rows.unionByName(rest, allowMissingColumns=True)
    prices = money.resolve_prices(F.col("unit_price").cast("double"), F.col("total_price").cast("double"), F.col("quantity").cast("double"))
    both = both.withColumn("p", prices).withColumn("unit", money.normalize_unit(F.coalesce("unit", F.lit(""))))
    out = both.withColumns({
        "unit_price": F.col("p.unit"), "total_price": F.col("p.total"), "price_basis": F.col("p.basis"), "unit_class": money.unit_class(F.col("unit")),
        "date": F.col("d.date"), "date_source": F.col("d.source"), "date_ambiguous": F.when(F.col("d.ambiguous"), "YES").otherwise(""), "year": F.col("d.year"), "month": F.col("d.month"),
        "quotation_key": F.col("k.key"), "quotation_key_basis": F.col("k.basis"), "make": T.normalize_text_value(F.coalesce("make", F.lit(""))), "model": T.normalize_text_value(F.coalesce("model", F.lit(""))),
    })
    raw = F.concat(F.coalesce("quotation_date", F.lit("")), F.coalesce(F.col("order_date").cast("string"), F.lit("")))
    reasons = T.let(F.col("d"), lambda d: checks.review_reasons(d["date"], raw, d["ambiguous"], F.col("matched_id"), F.col("data_source") == "ATTACHMENT_ITEM", F.col("unit_price"), F.col("total_price"), F.col("confidence"), F.col("description")))
    return out.withColumn("review_reasons", reasons).select(*COLUMNS)


def review(bank: DataFrame) -> DataFrame:
    """One row per item and reason."""
    # explode would have the reasons worked out once more, in a filter for rows without any
    return bank.select("data_source", "source_path", "ordinal", "order_id", F.explode_outer("review_reasons").alias("reason")).where("reason is not null")


def slim(bank: DataFrame, names: dict[str, str]) -> DataFrame:
    """A narrow copy: old name to new name, in order."""
    return bank.select(*[F.col(a).alias(b) for a, b in names.items()])


def reasons_by_quotation(bank: DataFrame, reasons: DataFrame) -> DataFrame:
    """(quotation_key, reasons): all reasons of all documents of a quotation, sorted and distinct."""
    paths = bank.where("source_path is not null").select("quotation_key", "source_path").distinct()
    return paths.join(reasons.select("source_path", "reason").distinct(), "source_path").groupBy("quotation_key").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))
