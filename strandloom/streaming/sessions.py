"""Piles over event time: an event opens a span of `gap`, and overlapping spans of a key are one session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_piles(events: DataFrame, key: str, ts: str, gap: str, late: str) -> DataFrame:
    """(key, start, end, members) per session, for a stream or a table; spans are half-open, so touching ones don't join.

    Events later than `late` behind the newest are left out; a session is given out once the watermark has passed it.
    """
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    w = F.session_window("__ts", gap).alias("w")
    return timed.groupBy(key, w).agg(F.count("*").alias("members")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "members")


def tumbling_counts(events: DataFrame, key: str, ts: str, width: str, late: str) -> DataFrame:
    """(key, start, n) per window of fixed width."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return timed.groupBy(key, F.window("__ts", width).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")
