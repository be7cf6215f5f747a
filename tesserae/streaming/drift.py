"""Annotation drift as a stream (an extension): how many values of each window are outside the vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drift(events: DataFrame, time: str, value: str, known: Column, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, value, n, unknown) per window; works on streams (late rows dropped by watermark) and on tables alike."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    of = rows.groupBy(F.window(time, window).alias("w"), F.col(value).alias("value")).agg(F.count("*").alias("n"), F.count_if(~F.coalesce(known, F.lit(False))).alias("unknown"))
    return of.select(F.col("w.start").alias("start"), "value", "n", "unknown")
