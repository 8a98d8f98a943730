"""Sessions of events by a gap, for batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """events (user_id, ts, ...) -> user_id, start, end, events. A stream drops what comes later than `late`."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        rows = rows.withWatermark("ts", late)
    out = rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def pending_once(stream: DataFrame, key: str, ts: str, within: str = "1 day") -> DataFrame:
    """Each key once within a time: what a log of finished keys is for a batch."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


def read_events(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
