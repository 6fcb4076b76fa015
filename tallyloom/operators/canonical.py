"""Canonical makes and models, product families."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.makes import make_parts
from tallyloom.functions.text import collapse_key


def display_spellings(rows: DataFrame, column: str) -> DataFrame:
    """Per collapsed key its most frequent spelling, ties alphabetical, and how many rows share the key."""
    counts = rows.select(F.col(column).alias("spelling")).where("spelling is not null and spelling != ''").groupBy("spelling").agg(F.count("*").alias("n"))
    keyed = counts.withColumn("key", collapse_key(F.col("spelling"))).where("key != ''")
    return keyed.groupBy("key").agg(F.min_by("spelling", F.struct((-F.col("n")).alias("n"), "spelling")).alias("display"), F.sum("n").alias("n_rows"))


def canonical_makes(rows: DataFrame, key: str, column: str, aliases: DataFrame) -> DataFrame:
    """(key, canonical, basis): every make named in the cell through alias, display spelling or itself; distinct, sorted, joined by ``|``.

    ``aliases``: (alias, canonical).  basis: ALIAS if an alias took part, else COSMETIC if the result equals the input, else RULE.
    Spellings are settled in a first pass over all rows.
    """
    parts = rows.select(key, F.col(column).alias("__raw"), F.explode(make_parts(F.col(column))).alias("part")).withColumn("__k", collapse_key(F.col("part")))
    shown = display_spellings(parts, "part").select(F.col("key").alias("__k"), "display")
    known = aliases.select(collapse_key(F.col("alias")).alias("__k"), F.col("canonical")).where("__k != ''").groupBy("__k").agg(F.max("canonical").alias("canonical"))
    told = parts.join(shown, "__k", "left").join(known, "__k", "left").withColumn("final", F.coalesce("canonical", "display", "part"))
    out = told.groupBy(key, "__raw").agg(F.array_join(F.array_sort(F.collect_set("final")), "|").alias("canonical"), F.bool_or(F.col("canonical").isNotNull()).alias("by_alias"))
    basis = F.when(F.col("by_alias"), "ALIAS").when(F.col("canonical") == F.col("__raw"), "COSMETIC").otherwise("RULE")
    return out.select(key, "canonical", basis.alias("basis"))


def valid_patterns(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Rules whose pattern compiles, in order."""
    good = []
    for pattern, family in rules:
        try:
            re.compile(pattern)
        except re.error:
            continue
        good.append((pattern, family))
    return good


def product_family(model: Column, description: Column, model_rules: list[tuple[str, str]], description_rules: list[tuple[str, str]]) -> Column:
    """Struct (family, basis): model prefixes first, then description patterns, each in rule order; one compiled expression, no join."""
    blank = F.struct(F.lit("").alias("family"), F.lit("").alias("basis"))
    parts = F.split(F.upper(F.coalesce(model, F.lit(""))), r"\|")
    text = F.coalesce(description, F.lit(""))
    out = None
    begins = lambda p: lambda x: F.trim(x).startswith(p.upper())
    tests = [(F.exists(parts, begins(p)), f, "MODEL_RULE") for p, f in model_rules]
    tests += [(text.rlike(f"(?i){p}"), f, "DESCRIPTION_RULE") for p, f in valid_patterns(description_rules)]
    for test, family, basis in tests:
        hit = F.struct(F.lit(family).alias("family"), F.lit(basis).alias("basis"))
        out = F.when(test, hit) if out is None else out.when(test, hit)
    return blank if out is None else out.otherwise(blank)
