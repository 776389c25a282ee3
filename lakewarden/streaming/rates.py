"""Event counts by hour and kind on a stream, closed by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakewarden.streaming.alerts import CooldownStream


def hourly_counts(events: DataFrame, ts: str, kind: str, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts per window; a window is given out once the watermark has passed its end."""
    return (
        events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
        .groupBy(F.window("__ts", width), kind).agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), kind, "n")
    )


def open_windows(spark: SparkSession, checkpoint: str, kind: str) -> DataFrame:
    """The windows that the watermark has not closed, once the input has ended: what the stream still holds."""
    held = spark.read.format("statestore").load(checkpoint)
    return held.select(
        F.col("key.window.start").alias("start"), F.col("key.window.end").alias("end"),
        F.col(f"key.{kind}").alias(kind), F.col("value.count").alias("n"))


def timeless(events: DataFrame, ts: str, kind: str) -> DataFrame:
    """Counts of the events without a time, which belong to no window."""
    none = F.lit(None).cast("timestamp")
    return events.where(F.col(ts).isNull()).groupBy(kind).agg(F.count("*").alias("n")).select(
        none.alias("start"), none.alias("end"), kind, "n")


def drain(stream: DataFrame | CooldownStream, path: str, checkpoint: str) -> None:
    """Append what the stream gives now to Parquet and stop."""
    if isinstance(stream, CooldownStream):
        return stream.drain(path, checkpoint)
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
