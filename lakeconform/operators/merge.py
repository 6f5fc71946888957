"""Merging new rows into a table by key, and what such a merge has changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.operators.dedup import duplicates, keep_first


def _by_key(df: DataFrame, keyed: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on keys that may be null; a null key equals a null key."""
    other = keyed.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    equal = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return df.join(other, equal, how)


def matching(df: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is among those of ``keyed``."""
    return _by_key(df, keyed, keys, "left_semi")


def unmatched(df: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among those of ``keyed``."""
    return _by_key(df, keyed, keys, "left_anti")


@dataclass(frozen=True)
class Merged:
    """What a merge does to the keys it touches: rows before, rows after, rows that lost."""

    before: DataFrame
    after: DataFrame
    dropped: DataFrame


def merge_first(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    settle: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Merged:
    """Merge rows into a table that holds the first row of each key.

    The first of the old winner and the new rows is the first of all rows ever seen, so the
    result is that of a full load, and merging the same rows again changes nothing. Only old
    rows of the new keys are read into the ranking. ``settle`` may store the rows of these keys.
    """
    before = settle(matching(old, new, keys))
    pool = settle(before.unionByName(new, allowMissingColumns=True))
    return Merged(before, keep_first(pool, keys, order_by), duplicates(pool, keys, order_by))


def replaced(old: DataFrame, after: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table with all rows of the touched keys exchanged for ``after``."""
    return unmatched(old, touched, keys).unionByName(after.select(*old.columns))


def changed_rows(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of either side that the other has not, repeated rows counted; equal rows cancel."""
    ours, theirs = before.select(*columns), after.select(*columns)
    return theirs.exceptAll(ours).unionAll(ours.exceptAll(theirs))


def new_since(
    df: DataFrame, value: Column, mark: Column, seen: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Rows of an export that an earlier load has not seen, with their watermark ``_value``.

    Rows after the mark are new. Rows at the mark, and rows without a readable watermark, may
    have been loaded before: they are new as far as they outnumber their equals in ``seen``,
    the rows of that kind that were loaded (EXCEPT ALL). Rows before the mark are not looked at.
    """
    rows = df.select(*columns, value.alias("_value"))
    after = rows.filter(F.col("_value") > mark)
    known = seen.select(*columns, F.col("_value"))
    edge = rows.filter(F.coalesce(F.col("_value") == mark, F.lit(True)))
    return after.unionAll(edge.exceptAll(known))


def next_edge(new: DataFrame, seen: DataFrame, mark: Column) -> DataFrame:
    """The loaded rows at the new mark or without a readable watermark, for the next load."""
    return seen.unionByName(new).filter(F.coalesce(F.col("_value") == mark, F.lit(True)))
