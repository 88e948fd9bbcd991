"""Feeds as streams: bounded-window deduplication, counts in event time, and the last decisive event of each case."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_feed(spark: SparkSession, folder: str, schema) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def unique_items(stream: DataFrame, key: str, when: str, late: str = "1 day") -> DataFrame:
    """Items once each, as far back as the watermark: a feed is a window, not an archive."""
    return stream.withWatermark(when, late).dropDuplicatesWithinWatermark([key])


def counts(stream: DataFrame, when: str, kind: str, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Items by kind and window of event time."""
    return stream.withWatermark(when, late).groupBy(F.window(when, window), kind).agg(F.count("*").alias("n"))


def sessions(stream: DataFrame, when: str, case: str, pause: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Bursts of events of a case that are at most a pause apart."""
    return stream.withWatermark(when, late).groupBy(F.session_window(when, pause), case).agg(F.count("*").alias("n"))


def last_decisive(stream: DataFrame, case: str, when: str, decisive) -> DataFrame:
    """The newest decisive event of each case, kept as a running aggregate (complete or update mode)."""
    return stream.where(decisive).groupBy(case).agg(F.max(when).alias("decided"))
