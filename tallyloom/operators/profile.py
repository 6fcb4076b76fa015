"""Profiles of text corpora and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text as T


def document_profile(docs: DataFrame, key: str, text: str) -> DataFrame:
    c = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        key,
        F.length(c).alias("n_chars"),
        T.word_count(c).alias("n_words"),
        T.line_count(c).alias("n_lines"),
        T.page_count(c).alias("n_pages"),
        T.symbol_ratio(T.strip(c)).alias("symbol_ratio"),
        T.alpha_ratio(T.strip(c)).alias("alpha_ratio"),
        T.document_status(c).alias("status"),
        F.array_join(T.suspicious(c), "; ").alias("warnings"),
    )


def exact_duplicates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Members of groups of equal texts (blank ones aside) with the size of their group."""
    keyed = docs.select(key, T.content_key(F.col(text)).alias("content_md5"), (T.strip(F.col(text)) != "").alias("some")).where("some").drop("some")
    sizes = keyed.groupBy("content_md5").agg(F.count("*").alias("group_size")).where("group_size > 1")
    return keyed.join(sizes, "content_md5")


def corpus_statistics(profile: DataFrame, columns: list[str]) -> DataFrame:
    """One row per measured column: total, mean, exact median, least, greatest."""
    parts = [
        profile.agg(F.lit(c).alias("measure"), F.sum(c).cast("double").alias("total"), F.avg(c).alias("mean"), F.percentile(F.col(c), 0.5).alias("median"), F.min(c).cast("double").alias("least"), F.max(c).cast("double").alias("greatest"))
        for c in columns
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def histogram(df: DataFrame, joined: str, by: str = ";") -> DataFrame:
    """How often each code stands in a column of joined codes."""
    codes = df.select(F.explode(F.split(F.coalesce(F.col(joined), F.lit("")), by)).alias("code")).select(F.trim("code").alias("code"))
    return codes.where("code != ''").groupBy("code").agg(F.count("*").alias("n"))


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-blank rows of each column and their percentage, from one pass."""
    filled = [F.count_if(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "").alias(c) for c in columns]
    one = df.agg(F.count("*").alias("__n"), *filled)
    flat = one.unpivot(["__n"], columns, "column_name", "n_filled")
    return flat.select("column_name", "n_filled", F.when(F.col("__n") > 0, F.round(F.col("n_filled") * 100.0 / F.col("__n"), 2)).otherwise(0.0).alias("percent"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    text = F.coalesce(F.trim(F.col(column).cast("string")), F.lit(""))
    return df.groupBy(F.when(text == "", "(blank)").otherwise(text).alias("value")).agg(F.count("*").alias("n"))
