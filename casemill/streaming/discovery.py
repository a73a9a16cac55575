"""Incremental discovery with Structured Streaming: new files are taken once, by availableNow, with a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def discover(spark: SparkSession, source: str, schema, target: str, checkpoint: str, key: str, date: str, lateness: str = "30 days") -> None:
    """Appends to target the rows of new files, each key once, that aren't older than the newest by more than lateness.

    The watermark bounds the state that duplicates are told by. Running it again without new files changes nothing.
    """
    rows = spark.readStream.schema(schema).parquet(source).withWatermark(date, lateness)
    fresh = rows.dropDuplicatesWithinWatermark([key])
    fresh.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def counts_by_window(rows: DataFrame, date: str, kind: str, width: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Counts by time window and kind, for batches and streams alike."""
    return rows.withWatermark(date, lateness).groupBy(F.window(date, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")


def apply_batches(rows: DataFrame, checkpoint: str, write) -> None:
    """Hands each micro-batch and its number to write(df, number), which must bear a repeated number."""
    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
