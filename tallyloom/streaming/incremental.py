"""Growing folders: every run handles only what is new, and survives being stopped.

The checkpoint remembers files that were handled; a batch's output is written under its number, so a batch that runs again after
a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.ranking import with_running


def process_new(spark: SparkSession, source: str, schema: str, checkpoint: str, target: str, transform: Callable[[DataFrame], DataFrame], fmt: str = "parquet", max_files: int = 1000) -> int:
    """Run ``transform`` over files that no run has seen yet; gives the number of batches."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/run={number}")

    query = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len([p for p in query.recentProgress if p["numInputRows"]])


def windowed_counts(events: DataFrame, time: str, kind: str, width: str, late: str) -> DataFrame:
    """Counts per window and kind for a stream; rows later than ``late`` no longer count."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def within_budget(docs: DataFrame, order: str, cost: str, daily: int, left: int, most: int) -> DataFrame:
    """Documents with ``admitted``: not over ``most`` alone, and inside the day's remaining count and cost, in order."""
    fits = docs.withColumn("fits", F.col(cost) <= most).withColumn("__one", F.col("fits").cast("int")).withColumn("__cost", F.when(F.col("fits"), F.col(cost)).otherwise(0))
    ranked = with_running(fits, [order], {"__n_sum": "__one", "__c_sum": "__cost"}, "__rank")
    return ranked.withColumn("admitted", F.col("fits") & (F.col("__n_sum") <= daily) & (F.col("__c_sum") <= left)).drop("__n_sum", "__c_sum", "__one", "__cost", "__rank", "fits")


class RateWindow:
    """A sliding minute of requests and tokens; ``wait`` says how long to sleep before the next call may go."""

    def __init__(self, requests: int, tokens: int, clock: Callable[[], float], seconds: float = 60.0) -> None:
        self.requests, self.tokens, self.clock, self.seconds = requests, tokens, clock, seconds
        self.calls: list[tuple[float, int]] = []

    def wait(self, tokens: int) -> float:
        now = self.clock()
        self.calls = [c for c in self.calls if now - c[0] < self.seconds]
        used = sum(n for _, n in self.calls)
        delay, left, count = 0.0, used, len(self.calls)
        for at, n in self.calls:
            if count < self.requests and left + tokens <= self.tokens:
                break
            delay, left, count = self.seconds - (now - at), left - n, count - 1
        return delay

    def took(self, tokens: int) -> None:
        self.calls.append((self.clock(), tokens))
