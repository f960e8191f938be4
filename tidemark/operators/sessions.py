"""Sessions of a key as a batch, its events spread over many tasks.

A session window groups all events of a key in one task. Here the events are grouped by key and time
slice: the local sessions of a slice are final unless they are its first or its last, and only those
two can go on in a neighbouring slice. They are chained by a window per key, which so holds at most
two rows for each slice that the key has events in, whatever the number of events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sliced_sessions(
    events: DataFrame, time_col: str, keys: Sequence[str], gap: str = "5 minutes", slice_seconds: int = 3600
) -> DataFrame:
    """(session_start, session_end, *keys, n_events): events at most ``gap`` apart share a session, which
    ends ``gap`` after its last event. Events without a time are in no session; a NULL key is a key."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    part = F.floor(micros / F.lit(slice_seconds * 1_000_000)).alias("_slice")
    timed = events.where(F.col(time_col).isNotNull()).select(*keys, F.col(time_col).alias("_time"), part)
    local = timed.groupBy(*keys, "_slice", F.session_window("_time", gap).alias("_session")).agg(
        F.count(F.lit(1)).alias("n_events")
    ).select(*keys, "_slice", F.col("_session.start").alias("session_start"), F.col("_session.end").alias("session_end"), "n_events")
    of_slice = Window.partitionBy(*keys, "_slice")  # the rows lie so already
    edge = F.col("session_start").isin(F.min("session_start").over(of_slice), F.max("session_start").over(of_slice))
    marked = local.withColumn("_edge", edge)
    out = ["session_start", "session_end", *keys, "n_events"]

    in_order = Window.partitionBy(*keys).orderBy("session_start")
    before = F.lag("session_end").over(in_order)
    edges = marked.where("_edge").withColumn("_new", F.coalesce(F.col("session_start") > before, F.lit(True)).cast("int"))
    edges = edges.withColumn("_chain", F.sum("_new").over(in_order))
    chained = edges.groupBy(*keys, "_chain").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n_events").alias("n_events"))
    return marked.where(~F.col("_edge")).select(*out).unionByName(chained.select(*out))
