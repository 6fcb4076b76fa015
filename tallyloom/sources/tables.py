"""Tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """``df`` in at least as many partitions as the cluster runs tasks, for heavy work over tables of a few files; larger tables stay as they are."""
    wanted = least or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, the first line as header, line breaks inside of quotes kept, a byte-order mark dropped; blanks are blank, not null."""
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False, nullValue="\x00", emptyValue="").na.fill("")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_optional_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The file, or an empty table if there is none."""
    return read_csv(spark, path) if exists(spark, path) else spark.createDataFrame([], schema)


class MissingInputs(ValueError):
    """Lists every input that is not there."""


def require(spark: SparkSession, *paths: str) -> None:
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise MissingInputs("missing inputs: " + ", ".join(missing))
