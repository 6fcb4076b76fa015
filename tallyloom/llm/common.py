"""Tables, shared storage and small helpers of the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a temporary folder on a single machine; on a cluster that is an error, since executors would write to their own disks.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str = "part") -> DataFrame:
    """``df`` written as a table to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def arrow_rows(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Rows and bytes of an Arrow batch: documents are long, so batches hold fewer of them than Spark's 10,000.  Only lowers the session's settings."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = int("".join(c for c in spark.conf.get(key) if c in "-0123456789") or 0)
        if now <= 0 or now > most:
            spark.conf.set(key, most)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string")) % parts


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
