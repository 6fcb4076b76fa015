"""Order history per customer, the usual industry, the directory of customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_history(orders: DataFrame, customer: str, value: str, status: str, region: str, date: str, pos: str) -> DataFrame:
    """Per customer: n_orders, total_value, regions, status_counts, latest_date and the latest order's status and position.

    Rows without a customer do not count.  Values that are no numbers are passed over.  Of equally late orders the
    last by ``pos`` is the latest; undated ones never are.  Statuses are counted before they are gathered, so
    a customer of any size costs one row per status.
    """
    rows = orders.where(F.col(customer).isNotNull())
    dated = F.when(F.col(date).isNotNull(), F.struct(F.col(date).alias("d"), F.col(pos).alias("p"), F.col(status).alias("s")))
    by_status = rows.groupBy(customer, status).agg(
        F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,2)")).alias("v"), F.collect_set(F.when(F.col(region) != "", F.col(region))).alias("r"), F.max(dated).alias("last")
    )
    told = F.concat_ws(":", F.col(status), F.col("n").cast("string"))
    out = by_status.groupBy(customer).agg(
        F.sum("n").alias("n_orders"),
        F.sum("v").cast("double").alias("total_value"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("r")))), ", ").alias("regions"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.coalesce(F.col(status), F.lit("")) != "", told))), ", ").alias("status_counts"),
        F.max("last").alias("last"),
    )
    return out.select(customer, "n_orders", "total_value", "regions", "status_counts", F.col("last.d").alias("latest_date"), F.col("last.s").alias("latest_status"), F.col("last.p").alias("latest_pos"))


def mode_with_ties(rows: DataFrame, key: str, value: str, date: str, pos: str, attribute: str | None = None) -> DataFrame:
    """Per key the most frequent non-blank value: ties by the later latest date, then by the first seen.

    Also n (rows with any value), n_value (rows with this one), and the attribute of the first row at the value's latest date.
    """
    some = rows.where(F.col(key).isNotNull() & (F.coalesce(F.col(value), F.lit("")) != ""))
    first_latest = F.min_by(F.col(attribute or value), F.struct(-F.unix_micros(F.col(date).cast("timestamp")), F.col(pos)))
    counts = some.groupBy(key, value).agg(F.count("*").alias("n_value"), F.max(date).alias("latest"), F.min(pos).alias("first_pos"), F.when(F.max(date).isNotNull(), first_latest).alias("attribute"))
    late = F.coalesce(F.unix_micros(F.col("latest").cast("timestamp")), F.lit(-(2**62)))
    best = F.max_by(F.struct(F.col(value), "n_value", "latest", "attribute"), F.struct("n_value", late, -F.col("first_pos")))
    out = counts.groupBy(key).agg(best.alias("b"), F.sum("n_value").alias("n"))
    columns = [key, F.col(f"b.{value}").alias(value), "n", F.col("b.n_value").alias("n_value")]
    return out.select(*columns, *([F.col("b.attribute").alias(attribute)] if attribute else []))


def representative_order(orders: DataFrame, key: str, date: str, pos: str, *columns: str) -> DataFrame:
    """Per key the order of the latest date, the first by ``pos`` among equals, and the number of orders."""
    best = F.max_by(F.struct(*columns, pos), F.struct(F.coalesce(F.unix_micros(F.col(date).cast("timestamp")), F.lit(-(2**62))), -F.col(pos)))
    return orders.where(F.col(key) != "").groupBy(key).agg(F.count("*").alias("n"), best.alias("order")).select(key, "n", "order.*")


def customer_directory(master: DataFrame, key: str, history: DataFrame, industry: DataFrame) -> DataFrame:
    """Every customer of the master with history and usual industry, null where there is none."""
    return master.join(history, key, "left").join(industry, key, "left")


def confidence_text(n_value: Column, n: Column) -> Column:
    return F.when(n.isNotNull(), F.concat(n_value.cast("string"), F.lit(" of "), n.cast("string"), F.lit(" orders")))
