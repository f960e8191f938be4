"""Watermarked tumbling and session windows over event streams (append mode)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's window, watermark and session gap.
WINDOW = "5 minutes"
WATERMARK = "15 seconds"
SESSION_GAP = "5 minutes"


def tumbling_counts(
    stream: DataFrame, time_col: str, keys: Sequence[str], count_col: str, window: str = WINDOW,
    watermark: str = WATERMARK, out: str = "num_hits",
) -> DataFrame:
    """Count of non-null ``count_col`` per (window, keys). A window is emitted once the
    watermark passes its end; rows behind the watermark are dropped (and counted in the
    query progress as numRowsDroppedByWatermark). State is keyed by (window, keys)."""
    agg = stream.withWatermark(time_col, watermark).groupBy(F.window(time_col, window), *keys).agg(
        F.count(F.col(count_col)).alias(out)
    )
    return agg.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, out
    )


def session_counts(
    stream: DataFrame, time_col: str, keys: Sequence[str], gap: str = SESSION_GAP, watermark: str = WATERMARK
) -> DataFrame:
    """Session windows per key: events at most ``gap`` apart share a session; a session closes
    ``gap`` after its last event and is emitted once the watermark passes that end."""
    agg = stream.withWatermark(time_col, watermark).groupBy(F.session_window(time_col, gap), *keys).agg(
        F.count(F.lit(1)).alias("n_events")
    )
    return agg.select(
        F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
        *keys, "n_events",
    )
