"""Writers with fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fixed(df: DataFrame, columns: list[str]) -> DataFrame:
    """Just these columns, missing ones blank, nulls blank."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def write_csv(df: DataFrame, path: str, columns: list[str], order: str | None = None, single: bool = False) -> None:
    """CSV with a header; one sorted file on request, for tables that people open."""
    out = fixed(df, columns)
    if single:
        out = out.coalesce(1)
    if order:
        out = out.sortWithinPartitions(order) if single else out.orderBy(order)
    out.write.mode("overwrite").csv(path, header=True, escape='"')


def write_reviewed(df: DataFrame, ok: str, review: str, failed) -> None:
    """Two tables from one: what passed, and what needs a look with its reason.  Each appears only when whole."""
    df.where(~failed).write.mode("overwrite").json(ok)
    df.where(failed).write.mode("overwrite").json(review)


def write_pages(df: DataFrame, path: str) -> None:
    """One line of JSON per page."""
    df.write.mode("overwrite").json(path)
