"""The corpus pipeline: language identification, quality classifier, near-duplicate removal, packing.

Every stage works on all that its predecessor kept, written as Parquet and read again; all but the last return
the columns of ``documents``.  The last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import langid, near_dedup, packing, quality
from tallyloom.llm.common import stored, table, tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the language is told with calibrated confidence; learned from their own ``lang``."""
    return langid.keep_identified(docs)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more; learned from the labelled among them."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return near_dedup.keep_one_of_each(docs, k=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of windows of 4096 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("quality", quality_filter), ("near_duplicates", near_duplicates), ("packing", pack)]

#: models and a tokenizer: SQL cannot express the stages; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
