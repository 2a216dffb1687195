"""Extension: event streams. The reference surface has none; these run the events table as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling_counts(events: DataFrame, length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and type; rows later than ``late`` are left out once their window is closed."""
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", length).alias("w"), "event_type")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Users' sessions: runs of events with no pause longer than ``gap``."""
    grouped = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id")
    return grouped.agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """The stream without events whose id was seen before, within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def append_to(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append closed results to Parquet, exactly once, until the input that is there is used up."""
    return rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
