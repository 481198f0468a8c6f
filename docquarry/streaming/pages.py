"""Streaming forms: new or changed reports as they arrive, and event-time counts with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def page_stream(spark: SparkSession, folder: str, schema, files_per_trigger: int = 100) -> DataFrame:
    """Page tables arriving as Parquet files in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def first_deliveries(pages: DataFrame, time_col: str = "ingested_at", delay: str = "1 day") -> DataFrame:
    """Each page content once: later deliveries of the same content within the delay are dropped; state ends with the watermark."""
    content = F.sha2(F.concat_ws("\u0001", F.coalesce("source_file", F.lit("")), F.coalesce(F.col("page_number").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))), 256)
    return pages.withColumn("content_hash", content).withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["content_hash"])


def window_counts(events: DataFrame, time_col: str = "ts", size: str = "1 hour", delay: str = "2 hours", by: list[str] = ("event_type",)) -> DataFrame:
    """Counts and sums per tumbling window; rows later than the watermark are dropped."""
    out = events.withWatermark(time_col, delay).groupBy(F.window(time_col, size), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), *by, "n", "total")


def run_into(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Feed micro-batches to a function until the input that is there has been read; restarts resume at the checkpoint."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
