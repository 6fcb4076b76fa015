"""Checks and scores of extraction examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = r"[\d,]+(?:\.\d+)?"


def leaks(examples: DataFrame, key: str = "example", given: str = "input", name: str = "product_name", numbers: tuple[str, ...] = ("unit_price", "total_price"), ignored: tuple[str, ...] = ()) -> DataFrame:
    """(key, kind, value): prices that are no money token of the example's own input, and long words that the input does not hold."""
    tokens = F.transform(F.regexp_extract_all(F.col(given), F.lit(f"({MONEY})"), 1), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"))
    out = None
    for n in numbers:
        value = F.col(n).cast("double")
        priced = examples.withColumn("__v", value).withColumn("__t", tokens)
        bad = priced.where("__v is not null and not exists(__t, x -> coalesce(abs(x - __v) < 0.01, false))")
        part = bad.select(key, F.lit(f"NUMBER:{n}").alias("kind"), F.col("__v").cast("string").alias("value"))
        out = part if out is None else out.unionByName(part)
    words = examples.select(key, F.lower(given).alias("__i"), F.explode(F.regexp_extract_all(F.coalesce(F.col(name), F.lit("")), F.lit(r"([A-Za-z][A-Za-z0-9\-]{4,})"), 1)).alias("value"))
    absent = words.where(~F.col("__i").contains(F.lower("value")) & ~F.lower("value").isin(*ignored)) if ignored else words.where(~F.col("__i").contains(F.lower("value")))
    return out.unionByName(absent.select(key, F.lit("WORD").alias("kind"), "value"))


def accuracy(pairs: DataFrame, key: str, same: str) -> DataFrame:
    """Per example precision, recall and whether all is right, from matched pairs (expected_pos, found_pos, same)."""
    n_expected, n_found = F.count("expected_pos"), F.count("found_pos")
    right = F.count_if(F.coalesce(F.col(same), F.lit(False)))
    return pairs.groupBy(key).agg(F.when(n_found > 0, right / n_found).alias("precision"), F.when(n_expected > 0, right / n_expected).alias("recall"), ((right == n_expected) & (n_found == n_expected)).alias("all_right"))


def means(scores: DataFrame) -> DataFrame:
    """Mean precision and recall over examples that have one, and the share that is all right."""
    return scores.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg(F.col("all_right").cast("int")).alias("document_accuracy"))
