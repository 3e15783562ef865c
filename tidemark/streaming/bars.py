"""Bars as streams: the batch operators' incremental forms. Merging them into a table is left to a table format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def event_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def bars(events: DataFrame, window: str = "1 hour", late: str = "2 hours", slide: str | None = None) -> DataFrame:
    """Open, high, low, close and count of the value by type and window; rows later than ``late`` are left out."""
    order = F.struct("ts", "event_id")
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    found = events.withWatermark("ts", late).groupBy("event_type", span.alias("w")).agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count(F.lit(1)).alias("volume"))
    return found.select("event_type", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "open", "high", "low", "close", "volume")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Runs of a user's events without a pause of ``gap``."""
    found = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
    return found.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events", "value")
