"""Assertions as a stream: the batch transformations run unchanged on each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_assertions(stream: DataFrame, delay: str = "7 days") -> DataFrame:
    """The newest value of each record, field and source; state older than the watermark
    is dropped by the engine."""
    kept = stream.withWatermark("retrieved_at", delay)
    return kept.groupBy(F.window("retrieved_at", "1 day"), "provider_id", "field", "source_class").agg(F.max_by("value", "retrieved_at").alias("value"), F.max("retrieved_at").alias("retrieved_at"))


def windowed_counts(events: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Event counts and sums by type in tumbling windows, late rows within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def each_batch(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Runs a batch transformation on each micro-batch and appends its rows; a batch that
    is run again overwrites its own folder, so rows are written once."""

    def write(rows: DataFrame, number: int) -> None:
        transform(rows).write.mode("overwrite").json(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
