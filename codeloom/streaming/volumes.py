"""Replay suppression and rolling code volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_replays(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop rows seen before within the watermark; state is kept only that long."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def window_volume(stream: DataFrame, code: str, time: str, delay: str, length: str = "1 day") -> DataFrame:
    """Rows per code and event-time window, emitted once the window is closed. Partial counts are
    combined before the shuffle, so a hot code sends one row per task."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, length), F.col(code))
        .agg(F.count("*").alias("volume"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), code, "volume")
    )
