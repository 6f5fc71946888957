"""Event-time windows over files that keep arriving.

A stream of files is followed up to the newest one and then left; the checkpoint remembers files,
watermark and open windows, so the next call goes on from there and a call without new files adds
nothing. A window is written once, when the watermark has passed its end. State is keys inside the
watermark's delay and sums of open windows, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeconform.functions import round_half_away


@dataclass(frozen=True)
class Progress:
    """What a call has done: batches with input, rows read, and rows dropped as too late."""

    batches: int
    rows: int
    late: int


def event_stream(spark: SparkSession, path: str, schema: StructType, files: int | None = None) -> DataFrame:
    """Parquet files under ``path`` in the order of their times, at most ``files`` a batch."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def closed_windows(
    events: DataFrame,
    keys: Sequence[str],
    *,
    time: str,
    identity: str,
    value: str,
    length: str,
    delay: str,
    slide: str | None = None,
    session: bool = False,
) -> DataFrame:
    """Rows and sum of ``value`` per window and keys, each ``identity`` counted once within ``delay``.

    Windows tumble, slide by ``slide``, or with ``session`` end after a gap of ``length``. Works on
    a batch frame too, where every window is closed. Rows without a time are in no window.
    """
    place = F.session_window(time, length) if session else F.window(time, length, slide)
    once = events.filter(F.col(time).isNotNull()).withWatermark(time, delay)
    once = once.dropDuplicatesWithinWatermark([identity]) if events.isStreaming else once.dropDuplicates([identity])
    sums = once.groupBy(place.alias("span"), *keys).agg(
        F.count("*").alias("n"), round_half_away(F.sum(value), 4).alias("total")
    )
    return sums.select(F.col("span.start").alias("starts"), F.col("span.end").alias("ends"), *keys, "n", "total")


def run_windows(windows: DataFrame, out: str, checkpoint: str) -> Progress:
    """Append the windows closed by all files present to ``out``, and return when they are done.

    The counts cover the steps that Spark keeps (``spark.sql.streaming.numRecentProgressUpdates``,
    100 unless set).
    """
    query = (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    steps = query.recentProgress
    late = sum(o["numRowsDroppedByWatermark"] for p in steps for o in p["stateOperators"])
    read = [p["numInputRows"] for p in steps]
    return Progress(sum(n > 0 for n in read), sum(read), late)
