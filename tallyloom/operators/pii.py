"""Masking of personal and commercial details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?\d[\d -]{8,}\d"
REGISTRATION = r"\b\d{2}[A-Z]{5}\d{4}[A-Z][A-Z0-9]Z[A-Z0-9]\b"
AMOUNT = r"\b\d{1,3}(?:,\d{2,3})+(?:\.\d{1,2})?\b"


def mask(c: Column, own_domains: list[str] | None = None) -> Column:
    """E-mails, registration numbers, phones and grouped amounts replaced by fixed marks, in that order; e-mails of own domains stay."""
    own = f"(?![A-Za-z0-9._%+-]*@(?:{'|'.join(d.replace('.', '[.]') for d in own_domains)}))" if own_domains else ""
    edge = r"(?<![A-Za-z0-9._%+-])" if own_domains else ""
    c = F.regexp_replace(c, edge + own + EMAIL, "[EMAIL]")
    c = F.regexp_replace(c, REGISTRATION, "[REG_ID]")
    c = F.regexp_replace(c, PHONE, "[PHONE]")
    return F.regexp_replace(c, AMOUNT, "[AMOUNT]")


def same_shape_number(c: Column, salt: Column) -> Column:
    """Every digit replaced by one drawn from a digest of salt and position: groups, decimals and length stay; a leading digit is never 0."""
    digest = F.sha2(F.concat(salt, F.lit("|"), c), 256)
    letters = F.filter(F.split(c, ""), lambda x: x != "")
    drawn = lambda i: F.conv(F.substring(F.repeat(digest, 8), i + 1, 2), 16, 10).cast("int")
    return F.array_join(F.transform(letters, lambda x, i: F.when(x.rlike("[0-9]"), F.when(i == 0, 1 + drawn(i) % 9).otherwise(drawn(i) % 10).cast("string")).otherwise(x)), "")


def exempt_lines(lines: DataFrame, document: str, pos: str, own: Column, before: int = 2, after: int = 2) -> DataFrame:
    """``lines`` with ``exempt``: whether a line of ``own`` stands at most so many lines before or after it in its document."""
    from pyspark.sql import Window

    w = Window.partitionBy(document).orderBy(pos).rowsBetween(-before, after)
    return lines.withColumn("exempt", F.coalesce(F.bool_or(own).over(w), F.lit(False)))


def remap(rows: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """A sensitive column through a table (value, replacement); what is not in it becomes ``[REDACTED]``, blanks stay."""
    table = known.groupBy(F.col("value").alias("__v")).agg(F.max("replacement").alias("__r"))
    out = rows.join(table, F.col(column) == F.col("__v"), "left")
    return out.withColumn(column, F.when(F.coalesce(F.col(column), F.lit("")) == "", F.col(column)).otherwise(F.coalesce("__r", F.lit("[REDACTED]")))).drop("__v", "__r")
