"""Rolling items up to quotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTED = 10


def priced_sum(total: Column, basis: Column) -> dict[str, Column]:
    """Aggregates of the non-negative totals: total_value, n_priced, n_negative and value_basis."""
    good = total.isNotNull() & (total >= 0)
    n_priced, bases = F.count_if(good), F.collect_set(F.when(good, basis))
    return {
        "total_value": F.sum(F.when(good, total.cast("decimal(20,4)"))).cast("double"),
        "n_priced": n_priced,
        "n_negative": F.count_if(total < 0),
        "value_basis": F.when(n_priced == 0, "NONE").when(n_priced < F.count("*"), "PARTIAL").when((F.size(bases) == 1) & F.array_contains(bases, "REPORTED"), "REPORTED").otherwise("MIXED_DERIVED"),
    }


RANKS = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}


def best_scalar(value: Column, dated: Column, confidence: Column, pos: Column) -> Column:
    """The non-blank value of the best row: dated by an order first, then by confidence, then the first by position."""
    rank = F.when(confidence == "HIGH", 3).when(confidence == "MEDIUM", 2).when(confidence == "LOW", 1).otherwise(0)
    text = F.trim(value.cast("string"))
    ok = (text != "") & (F.lower(text) != "nan")
    return F.max_by(F.when(ok, value), F.when(ok, F.struct(dated.cast("int").alias("o"), rank.alias("r"), (-pos).alias("p"))))


def capped_list(value: Column, most: int = LISTED) -> Column:
    """Distinct non-blank values in order, the first ``most`` joined, then how many more there are."""
    values = F.array_sort(F.collect_set(F.when(F.trim(value.cast("string")) != "", F.trim(value.cast("string")))))
    shown = F.array_join(F.slice(values, 1, most), "; ")
    return F.when(F.size(values) > most, F.concat(shown, F.lit("; …+"), (F.size(values) - most).cast("string"), F.lit(" more"))).otherwise(shown)


def source_kind(kind: Column) -> Column:
    return F.when(F.bool_or(kind == "ATTACHMENT_ITEM"), "ATTACHMENT_ITEM").when(F.bool_and(kind == "ERP_ORDER_ONLY"), "ERP_ORDER_ONLY").otherwise(F.min(F.when(kind != "", kind)))


def roll_up(items: DataFrame, key: str, total: str, basis: str, confidence: str, pos: str, lists: list[str], scalars: list[str], dated: str, kind: str | None = None) -> DataFrame:
    """One row per quotation: counts, priced sum, confidence histogram, capped lists and best scalars, in one aggregation."""
    level = lambda x: F.count_if(F.col(confidence) == x).alias(f"n_{x.lower()}")
    columns = [F.count("*").alias("n_items"), *[c.alias(n) for n, c in priced_sum(F.col(total), F.col(basis)).items()], level("HIGH"), level("MEDIUM"), level("LOW")]
    columns += [capped_list(F.col(c)).alias(f"{c}_list") for c in lists]
    columns += [best_scalar(F.col(c), F.col(dated), F.col(confidence), F.col(pos)).alias(c) for c in scalars]
    if kind:
        columns.append(source_kind(F.col(kind)).alias("data_source"))
    return items.groupBy(key).agg(*columns)


def conservation(items: DataFrame, rolled: DataFrame, key: str) -> DataFrame:
    """One row: items in, items counted by the roll-up, repeated or blank keys, negative totals, and whether all is well."""
    a = items.agg(F.count("*").alias("items_in"))
    keys = rolled.agg(F.sum("n_items").alias("items_out"), (F.count("*") - F.count_distinct(key)).alias("bad_keys"), F.count_if(F.col("total_value") < 0).alias("negative_totals"))
    both = a.crossJoin(keys)  # one row each
    return both.withColumn("ok", (F.col("items_in") == F.col("items_out")) & (F.col("bad_keys") == 0) & (F.col("negative_totals") == 0))
