"""Ranks and running sums over a whole table without bringing it to one task."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; a temporary one where it is unset on a single machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _checkpointed(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def with_running(df: DataFrame, order: list, sums: dict[str, str], rank: str = "rank") -> DataFrame:
    """``df`` with its rank in ``order`` (from 1) and running sums (new column: summed column).

    Rows are range-partitioned and sorted; each partition counts for itself, and only one row of totals per partition is summed
    up in order.  The sorted rows are checkpointed, so partitions cannot shift between the two passes.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = _checkpointed(dealt.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()))
    inside = Window.partitionBy("__p").orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("__p").agg(F.count("*").alias("__n"), *[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select("__p", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ["__n", *[f"__t_{n}" for n in sums]]])
    out = rows.join(F.broadcast(offsets), "__p")
    columns = {rank: (F.row_number().over(inside) + F.col("__n_before")).cast("long")}
    columns |= {n: F.sum(c).over(inside) + F.col(f"__t_{n}_before") for n, c in sums.items()}
    return out.withColumns(columns).drop("__p", "__i", *[c for c in out.columns if c.endswith("_before") and c.startswith("__")])


def with_rank(df: DataFrame, order: list, rank: str = "rank") -> DataFrame:
    return with_running(df, order, {}, rank)
