"""Event-time windows and sessions. Each function takes a batch or a streaming table with a timestamp column ts and gives the same rows for both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _late(events: DataFrame, delay: str) -> DataFrame:
    # Watermarks need the type with a time zone.
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay) if events.isStreaming else events


def tumbling(events: DataFrame, keys: list[str], width: str, value: str, delay: str = "1 hour") -> DataFrame:
    """(keys, w_start, n, total) of fixed windows; events later than the delay are left out of a stream."""
    rows = _late(events, delay).groupBy(F.window("ts", width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 6).alias("total"))
    return rows.select(*keys, F.col("w.start").alias("w_start"), "n", "total")


def sessions(events: DataFrame, keys: list[str], gap: str, delay: str = "1 hour") -> DataFrame:
    """(keys, s_start, s_end, n) of stretches of events less than the gap apart; a session ends one gap after its last event."""
    rows = _late(events, delay).groupBy(F.session_window("ts", gap).alias("s"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(*keys, F.col("s.start").alias("s_start"), F.col("s.end").alias("s_end"), "n")
