"""Choosing a snapshot, and loading only what is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_snapshot(
    df: DataFrame, requested: str | None = None, column: str = "ingest_date"
) -> DataFrame:
    """Rows of the requested snapshot if it exists, else of the newest; the column is dropped.

    The choice is a scalar subquery over the snapshot column, in the column's own type. It
    reads that column of every row; for a table partitioned by it, take the dates from the
    folder names instead (``sources.lake.snapshot_dates``).
    """
    if column not in df.columns:
        return df
    day = F.col(column)
    chosen = F.max(day)
    if requested is not None:
        chosen = F.coalesce(F.max(F.when(day.cast("string") == requested, day)), chosen)
    return df.filter(day == df.select(column).agg(chosen).scalar()).drop(column)


def incremental(
    df: DataFrame, watermark: str, since: Column, parser: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Rows whose watermark lies after ``since``; unparseable watermarks are not new."""
    value = F.col(watermark)
    return df.filter((parser(value) if parser else value) > since)


def next_watermark(
    df: DataFrame, watermark: str, parser: Callable[[Column], Column] | None = None
) -> DataFrame:
    """The highest watermark, to be the next ``since``."""
    value = F.col(watermark)
    return df.agg(F.max(parser(value) if parser else value).alias("next_watermark"))
