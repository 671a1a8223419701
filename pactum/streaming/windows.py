"""Event-time signals: windows, sessions and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def on_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on a time column; times without a zone are read in the session zone."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_surge(stream: DataFrame, ts: str, flag: Column, every: str, delay: str, slide: str | None = None,
                 by: Sequence[str] = ()) -> DataFrame:
    """Rows and flagged rows per closed window; sliding when `slide` is given."""
    span = F.window(ts, every, slide) if slide else F.window(ts, every)
    return (on_event_time(stream, ts, delay).groupBy(span.alias("_w"), *by)
            .agg(F.count("*").alias("n"), F.count_if(flag).alias("n_high"))
            .select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *by, "n", "n_high"))


def stream_sessions(stream: DataFrame, ts: str, flag: Column, gap: str, delay: str, key: str) -> DataFrame:
    """Bursts of flagged rows per key, split where nothing happened for `gap`."""
    return (on_event_time(stream.filter(flag), ts, delay)
            .groupBy(F.session_window(ts, gap).alias("_s"), key)
            .agg(F.count("*").alias("n"))
            .select(key, F.col("_s.start").alias("start"), F.col("_s.end").alias("end"), "n"))


def stream_dedup(stream: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """Each key once, as long as copies arrive within the delay."""
    return on_event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys))
