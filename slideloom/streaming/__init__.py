"""Streams of pixels kept as running histograms.

The batch reference re-reads every finished sample when one is added; sums of counts may
instead be kept as a stream's state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from slideloom.operators.hist import merged


def running_histogram(pixels: DataFrame, keys: list[str], seen_at: str, late: str = "1 hour") -> DataFrame:
    """(window, keys, v, n): histograms of a stream per hour of arrival; rows later than ``late`` are dropped."""
    timed = pixels.withWatermark(seen_at, late)
    return timed.groupBy(F.window(seen_at, "1 hour"), *keys, "v").agg(F.count("*").alias("n"))


def merge_histograms(stream: DataFrame, keys: list[str], store: str, checkpoint: str) -> StreamingQuery:
    """Adds each micro-batch's counts to the histograms kept as Parquet under ``store``.

    Each batch writes its own folder, named by its number, so that a batch that is run again
    replaces what it wrote before.
    """

    def add(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy(*keys, "v").agg(F.count("*").alias("n"))
        counted.write.mode("overwrite").parquet(f"{store}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored_histograms(spark: SparkSession, store: str) -> DataFrame:
    """The histograms kept under ``store``, all batches added up."""
    return merged(spark.read.parquet(store).drop("batch"))
