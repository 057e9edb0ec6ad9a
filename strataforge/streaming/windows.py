"""Structured Streaming over event tables: an addition, as the batch operators need no stream.

Both functions take a streaming or a batch frame, so tests can hold one against the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, time: str, keys: list[str], value: str, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window_start, keys, n, total) by tumbling event-time windows; events later than the watermark are dropped by a stream."""
    events = events.withColumn(time, F.col(time).cast("timestamp"))  # watermarks need a zone
    if events.isStreaming:
        events = events.withWatermark(time, late)
    out = events.groupBy(F.window(time, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def first_events(events: DataFrame, time: str, keys: list[str], late: str = "2 days") -> DataFrame:
    """Events without later repeats of the same keys; a stream forgets keys once the watermark passes them."""
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)
