"""Windowed statistics, deduplication and enrichment of observation streams.

Every function takes a batch or a streaming DataFrame: the batch result is what
a finished stream must equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def timed(df: DataFrame, at: str = "fetched_at") -> DataFrame:
    """Event time as TIMESTAMP: watermarks refuse TIMESTAMP_NTZ."""
    return df.withColumn(at, F.col(at).cast("timestamp"))


def _stats(df: DataFrame, window: Column, by: list[str], value: str) -> DataFrame:
    grouped = df.groupBy(window.alias("w"), *by).agg(
        F.count("*").alias("n"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"),
    )
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "min_value", "max_value", "mean_value"
    )


def _marked(df: DataFrame, at: str, lateness: str | None) -> DataFrame:
    return df.withWatermark(at, lateness) if df.isStreaming and lateness else df


def st_tumbling(df: DataFrame, width: str, by: list[str], value: str, at: str = "fetched_at", lateness: str | None = None) -> DataFrame:
    return _stats(_marked(df, at, lateness), F.window(at, width), by, value)


def st_sliding(df: DataFrame, width: str, slide: str, by: list[str], value: str, at: str = "fetched_at", lateness: str | None = None) -> DataFrame:
    return _stats(_marked(df, at, lateness), F.window(at, width, slide), by, value)


def st_session(df: DataFrame, gap: str, by: list[str], value: str, at: str = "fetched_at", lateness: str | None = None) -> DataFrame:
    return _stats(_marked(df, at, lateness), F.session_window(at, gap), by, value)


def st_dedupe(df: DataFrame, key: list[str], at: str = "fetched_at", lateness: str = "1 day") -> DataFrame:
    """First arrival of each key; on a stream, state is held for ``lateness`` only.

    What a stream keeps can depend on how its input falls into micro-batches.
    """
    if df.isStreaming:
        return df.withWatermark(at, lateness).dropDuplicatesWithinWatermark(key)
    return df.dropDuplicates(key)


def st_join_calendar(stream: DataFrame, dimension: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """A stream joined to a static table: the static side is re-planned per batch."""
    return stream.join(dimension, on, how)
