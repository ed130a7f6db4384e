"""Picks as a stream: thresholds, removal of repeats, and per-window counts with late picks bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.operators import picks


def clean_stream(stream: DataFrame, p: float = 0.2, s: float = 0.5, delay: str = "60 seconds") -> DataFrame:
    """Normalised picks above their thresholds, each key once within the watermark."""
    df = picks.above_threshold(picks.normalize(stream), p, s)
    return df.withWatermark("phase_time", delay).dropDuplicatesWithinWatermark(picks.KEY)


def window_counts(stream: DataFrame, window: str = "15 minutes", delay: str = "60 seconds") -> DataFrame:
    """Picks and stations of each tumbling window; a window closes once the watermark has passed it."""
    df = stream.withWatermark("phase_time", delay)
    return df.groupBy(F.window("phase_time", window)).agg(F.count("*").alias("n_picks"), F.approx_count_distinct("station_id").alias("n_stations"))
