"""Binned tracks from a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_bins(events: DataFrame, time: str = "ts", track: str = "event_type", value: str = "value", width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Sums by track and time bin of a streaming (or batch) table; bins close when the watermark has passed them."""
    rows = events.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", late)
    out = rows.groupBy(F.window("_at", width).alias("w"), F.col(track).alias("track")).agg(F.sum(value).alias("value"), F.count("*").alias("n"))
    return out.select("track", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "value", "n")
