"""Joins whose lookup side may repeat keys, and joins with a second key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_of_each(right: DataFrame, key: str, pos: str) -> DataFrame:
    """One row per non-blank key: the last by ``pos``."""
    rest = [c for c in right.columns if c != key]
    rows = right.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), pos).alias("r")).select(key, "r.*")


def left_lookup(left: DataFrame, right: DataFrame, key: str, pos: str) -> DataFrame:
    """Left join in which the last of repeated right keys wins and a blank key never matches; ``found`` tells."""
    return left.join(last_of_each(right, key, pos).withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def linked(orders: DataFrame, key: str, links: DataFrame, link: str) -> DataFrame:
    """Orders that some document is linked to; links are made distinct first, so nothing is counted twice."""
    return orders.join(links.select(F.col(link).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def unlinked(orders: DataFrame, key: str, links: DataFrame, link: str) -> DataFrame:
    return orders.join(links.select(F.col(link).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def fallback_join(left: DataFrame, right: DataFrame, first: tuple[str, str], second: tuple[str, str], columns: list[str], pos: str) -> DataFrame:
    """Left join on the first pair of keys, else on the second; ``matched_by`` is 1, 2 or null."""
    pick = F.struct(*columns)
    one = right.where(F.col(first[1]).isNotNull()).groupBy(F.col(first[1]).alias("__k1")).agg(F.max_by(pick, pos).alias("__r1"))
    two = right.where(F.col(second[1]).isNotNull()).groupBy(F.col(second[1]).alias("__k2")).agg(F.max_by(pick, pos).alias("__r2"))
    out = left.join(one, F.col(first[0]) == F.col("__k1"), "left").join(two, F.col(second[0]) == F.col("__k2"), "left")
    by = F.when(F.col("__r1").isNotNull(), 1).when(F.col("__r2").isNotNull(), 2)
    return out.withColumn("__r", F.coalesce("__r1", "__r2")).select(*left.columns, *[F.col(f"__r.{c}").alias(c) for c in columns], by.alias("matched_by"))


def union_kinds(items: DataFrame, orders: DataFrame, columns: list[str]) -> DataFrame:
    """Item rows and order-only rows under one fixed list of columns; missing ones are null."""
    both = items.unionByName(orders, allowMissingColumns=True)
    return both.select(*[F.col(c) if c in both.columns else F.lit(None).cast("string").alias(c) for c in columns])


def keep_first(rows: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """One row for each key: the first by ``pos``."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), pos).alias("r")).select(*keys, "r.*")


def resolve_column(df: DataFrame, candidates: list[str]) -> Column | None:
    """The first candidate that names a column exactly, else the first that does so but for case."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    for c in candidates:
        if c in df.columns:
            return F.col(c)
    return next((F.col(lower[c.lower()]) for c in candidates if c.lower() in lower), None)
