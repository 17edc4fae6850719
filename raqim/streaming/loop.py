"""Crawl tables as streams: attempts over event time, and queue batches as micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, files: int = 10) -> DataFrame:
    """New Parquet files of a folder, ``files`` per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def attempt_rates(attempts: DataFrame, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """(start, end, status, attempts, seconds) of tumbling windows; rows later than ``late`` behind the newest are dropped."""
    timed = attempts.withWatermark("started_at", late).groupBy(F.window("started_at", window).alias("w"), "status")
    seconds = F.col("completed_at").cast("double") - F.col("started_at").cast("double")
    return timed.agg(F.count("*").alias("attempts"), F.sum(seconds).alias("seconds")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "status", "attempts", "seconds")


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Work through what is there in micro-batches and stop; a restart goes on behind the last finished batch."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
