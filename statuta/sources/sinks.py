"""Sinks: listings, raw JSON and files that are never overwritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shortened(s: Column, width: int) -> Column:
    """K-01: text cut to width characters, the last an ellipsis if it is cut."""
    return F.when(F.char_length(s) > width, F.concat(F.left(s, F.lit(width - 1)), F.lit("…"))).otherwise(s)


def listing(df: DataFrame, columns: list[str], width: int = 160) -> DataFrame:
    """K-01: one line per row, empty values left out."""
    return df.select(shortened(F.concat_ws(" | ", *[F.col(c).cast("string") for c in columns]), width).alias("line"))


def raw_json(df: DataFrame) -> DataFrame:
    """K-02: each row as JSON."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def save_new(df: DataFrame, path: str) -> None:
    """K-03: written only where nothing is yet."""
    df.write.mode("errorifexists").parquet(path)
