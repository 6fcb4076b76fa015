"""Table functions for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tallyloom.operators.lines import ITEM_DDL, ITEM_FIELDS, parse_lines


class ParseItems:
    """The items of one quotation text, in order."""

    def eval(self, text: str):
        for i, item in enumerate(parse_lines((text or "").splitlines())["items"]):
            f = [item.fields.get(k, "") for k in ITEM_FIELDS]
            yield i, item.item_no, item.description, *f, item.quantity, item.unit, item.unit_price_raw, item.unit_price, item.total_price_raw, item.total_price, item.raw, item.confidence


def register(spark: SparkSession) -> None:
    """Makes ``SELECT ... FROM docs, LATERAL parse_items(docs.text)`` available."""
    spark.udtf.register("parse_items", udtf(ParseItems, returnType=f"ordinal int, {ITEM_DDL}"))
