"""Streaming forms: an extension over the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def source_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 64) -> DataFrame:
    """New Parquet files of a dataset folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def deduplicated(stream: DataFrame, key: str, time: str, lateness: str) -> DataFrame:
    """Each key once within the watermark, whose age bounds the state."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, lateness: str, length: str, slide: str | None, *keys: str) -> DataFrame:
    """Counts per tumbling or sliding window and keys; rows later than the watermark are left out."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return stream.withWatermark(time, lateness).groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def sessions(stream: DataFrame, time: str, lateness: str, gap: str, key: str) -> DataFrame:
    """Runs of a key's rows with no gap of `gap` or more."""
    grouped = stream.withWatermark(time, lateness).groupBy(F.session_window(time, gap).alias("w"), key)
    return grouped.agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def upsert_objects(stream: DataFrame, build: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str):
    """Rebuilds the objects that a micro-batch touches: build(batch) gives their rows, write(rows, batch id) stores them."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, number: write(build(batch), number)).start()
