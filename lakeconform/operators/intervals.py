"""Intervals that overlap: a join without an inequality of rows, and the load over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Widths in days of the levels of buckets: each interval has a level as wide as itself at least,
# where it meets at most two buckets. The last is wider than the calendar.
WIDTHS = tuple(32 * 8**level for level in range(7))
OPEN_END = "DATE'9999-12-31'"


def _days(column: str) -> Column:
    return F.datediff(F.col(column), F.lit("1970-01-01").cast("date"))


def _placed(df: DataFrame, start: str, end: str, prefix: str) -> DataFrame:
    """Each interval in its buckets, at its own level and at all wider ones."""
    first, last = _days("_start"), _days("_end")
    own = F.lit(len(WIDTHS) - 1)
    for level in reversed(range(len(WIDTHS) - 1)):
        own = F.when(last - first < WIDTHS[level], F.lit(level)).otherwise(own)
    ranges = F.array(
        *[
            F.struct(
                F.lit(level).alias("level"),
                F.floor(first / width).cast("int").alias("low"),
                F.floor(last / width).cast("int").alias("high"),
            )
            for level, width in enumerate(WIDTHS)
        ]
    )
    ended = F.coalesce(F.col(end), F.expr(OPEN_END))
    rows = (
        df.withColumns({"_start": F.col(start), "_end": ended})
        .filter("_start IS NOT NULL AND _start <= _end")
        .withColumns({"_own": own, "_ranges": ranges})
        .withColumn("_range", F.explode(F.filter("_ranges", lambda r: r["level"] >= F.col("_own"))))
        .withColumn("_bucket", F.explode(F.sequence("_range.low", "_range.high")))
    )
    return rows.select(
        *[F.col(c).alias(f"{prefix}{c}") for c in df.columns],
        F.col("_start").alias(f"{prefix}_start"),
        F.col("_end").alias(f"{prefix}_end"),
        F.col("_own").alias(f"{prefix}_own"),
        F.col("_range.low").alias(f"{prefix}_low"),
        F.col("_range.level").alias(f"{prefix}_level"),
        F.col("_bucket").alias(f"{prefix}_bucket"),
    )


def overlap_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], start: str, end: str, where: Column | None = None
) -> DataFrame:
    """Pairs of rows with equal keys whose closed intervals of days overlap, each pair once.

    Columns come as ``l_...`` and ``r_...``, with ``overlap_start`` and ``overlap_end``. Intervals
    meet in buckets of a width that grows with their length, so one of many years takes no more
    buckets than one of a week. A pair meets at the level of its longer interval and there only
    in the first bucket both have: nothing has to be made distinct. A null end is open; a null
    start, or an end before its start, overlaps nothing. ``where`` narrows the pairs.
    """
    a, b = _placed(left, start, end, "l_"), _placed(right, start, end, "r_")
    on = [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys]
    on += [F.col("l__level") == F.col("r__level"), F.col("l__bucket") == F.col("r__bucket")]
    on += [
        F.col("l__level") == F.greatest("l__own", "r__own"),
        F.col("l__bucket") == F.greatest("l__low", "r__low"),
        F.col("l__start") <= F.col("r__end"),
        F.col("r__start") <= F.col("l__end"),
    ]
    if where is not None:
        on.append(where)
    pairs = a.join(b, on)
    shown = [c for c in pairs.columns if not c.startswith(("l__", "r__"))]
    return pairs.select(
        *shown,
        F.greatest("l__start", "r__start").alias("overlap_start"),
        F.least("l__end", "r__end").alias("overlap_end"),
    )


def load_spans(df: DataFrame, key: str, start: str, end: str, load: str, limit: float) -> DataFrame:
    """Spans of days in which a key's summed load is above the limit, with the highest load.

    Loads are first added up per key and day of change, so that the running sum goes over days
    and not over rows, and a key with very many intervals stays small. A null end is open.
    """
    rows = df.filter(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(load).isNotNull())
    ended = F.coalesce(F.col(end), F.expr(OPEN_END))
    rows = rows.filter(F.col(start) <= ended)
    steps = rows.select(
        key,
        F.inline(
            F.array(
                F.struct(F.col(start).alias("day"), F.col(load).cast("double").alias("step")),
                F.struct(F.date_add(ended, 1).alias("day"), (-F.col(load)).cast("double").alias("step")),
            )
        ),
    )
    days = steps.groupBy(key, "day").agg(F.sum("step").alias("step"))
    in_time = Window.partitionBy(key).orderBy("day")
    level = days.withColumn("load", F.round(F.sum("step").over(in_time), 6)).withColumn(
        "until", F.lead("day").over(in_time)
    )
    above = (F.col("load") > limit) & F.col("until").isNotNull()
    begins = above & ~F.coalesce(F.lag(above).over(in_time), F.lit(False))
    spans = level.withColumn("_above", above).withColumn("_span", F.sum(begins.cast("int")).over(in_time))
    return (
        spans.filter("_above")
        .groupBy(key, "_span")
        .agg(
            F.min("day").alias("span_start"),
            F.date_sub(F.max("until"), 1).alias("span_end"),
            F.max("load").alias("highest_load"),
        )
        .drop("_span")
    )
