"""Keeping the latest row of each key of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(stream: DataFrame, key: str, position: str) -> DataFrame:
    """The row with the greatest ``position`` of each key, as an aggregate that works on tables and streams alike (output mode update or complete)."""
    return stream.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*stream.columns), position).alias("_row")).select("_row.*")


def windowed_counts(stream: DataFrame, time: str, key: str, width: str, late: str) -> DataFrame:
    """(window, key, n): rows in windows of event time; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("window"), key).agg(F.count("*").alias("n"))
