"""One row per key, chosen by a total order, with every other row accounted for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import MapType

from lakeconform.operators.quality import mark_rejected

# Enough to cut a key that holds a third of 100 TB into pieces one task can sort.
DEFAULT_SLICES = 4096


def _sortable(df: DataFrame) -> list[str]:
    return [f"`{f.name}`" for f in df.schema.fields if not isinstance(f.dataType, MapType)]


def total_order(df: DataFrame, leading: Sequence[str]) -> str:
    """SQL sort terms: the given expressions, then every column, nulls last.

    Without the tail a tie would be settled by the order in which shuffle blocks arrive.
    Rows that still tie are equal in every column, so either may win.
    """
    terms = dict.fromkeys([*leading, *[c for c in _sortable(df) if c.strip("`") not in leading]])
    return ", ".join(f"{term} ASC NULLS LAST" for term in terms)


def _rank(keys: Sequence[str], order: str) -> str:
    return f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order})"


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """The first row of each key. ``order_by`` holds column names or SQL expressions.

    Only rank 1 is asked for, so Spark drops the losers of each input partition before the
    shuffle (WindowGroupLimit): a key with a third of all rows sends one row per partition.

    Rows that fail ``where`` (a condition that is never unknown) stand behind all others and
    are not kept. Filtering them out first would give the same rows, but Catalyst would push
    that filter below the parsing it depends on and so parse everything twice.
    """
    order = total_order(df, order_by or keys)
    if where is None:
        ranked = df.selectExpr("*", f"{_rank(keys, order)} AS _rank")
        return ranked.filter("_rank = 1").drop("_rank")
    passing = df.selectExpr("*", f"({where}) AS _passes")
    ranked = passing.selectExpr("*", f"{_rank(keys, f'_passes DESC, {order}')} AS _rank")
    return ranked.filter("_rank = 1 AND _passes").drop("_rank", "_passes")


def surplus_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] | None = None,
    slices: int = DEFAULT_SLICES,
) -> DataFrame:
    """Every row except the first of its key.

    The rows behind the first cannot be pruned before the shuffle, so each key is ranked in
    two steps: inside ``slices`` slices, then among the slice winners, at most ``slices``
    per key. The slice mixes the row's hash with its input partition, which spreads unlike
    rows and exact copies; both are the same when a lost task runs again.
    """
    order = total_order(df, order_by or keys)
    hashed = f"xxhash64({', '.join(_sortable(df))})"
    return (
        df.selectExpr(
            "*", f"CAST(pmod({hashed} + spark_partition_id(), {slices}) AS INT) AS _slice"
        )
        .selectExpr("*", f"{_rank([*keys, '_slice'], order)} AS _local")
        # Slice winners of a key meet in one group; the others stay in their slice.
        .selectExpr("*", "IF(_local = 1, -1, _slice) AS _tier")
        .selectExpr("*", f"{_rank([*keys, '_tier'], order)} AS _rank")
        .filter("_local > 1 OR _rank > 1")
        .drop("_slice", "_local", "_tier", "_rank")
    )


def duplicate_reason(keys: Sequence[str]) -> str:
    return f"duplicate_business_key[{','.join(keys)}]"


def duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """The surplus rows with their rejection reason; none without keys."""
    surplus = surplus_rows(df, keys, order_by) if keys else df.limit(0)
    return mark_rejected(surplus, duplicate_reason(keys))


def deduplicate(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(kept, dropped)``; together they are the input. Without keys nothing is dropped."""
    return keep_first(df, keys, order_by) if keys else df, duplicates(df, keys, order_by)
