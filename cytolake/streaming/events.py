"""Structured Streaming over an event table; an extension, beyond what batch modules need."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, sf_dir: str, per_trigger: int = 1) -> DataFrame:
    """The events files as a stream; the schema comes from the files that are there. A stream reads folders: of a single file, that file of its folder."""
    path = f"{sf_dir}/events.parquet"
    batch = spark.read.parquet(path)
    alone = batch.inputFiles()[0].endswith("/events.parquet")
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "events.parquet" if alone else "*.parquet")
    return stream.parquet(sf_dir if alone else path)


def window_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Count and mean value of each event type in tumbling windows; rows later than the watermark are dropped."""
    x = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return x.groupBy(F.window("at", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean")).select("w.start", "w.end", "event_type", "n", "mean")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Session length and events of each user."""
    x = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return x.groupBy(F.session_window("at", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("w.start", "w.end", "user_id", "n")
