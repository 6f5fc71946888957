"""What differs between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.operators.merge import matching


def snapshot_difference(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of either snapshot that the other has not, by key: what happened, how often, where.

    Equal rows cancel, copy by copy, as EXCEPT ALL in both directions would have it; copies are
    counted before the shuffle, so a row repeated millions of times is one row there. If one row
    of a key is left on either side the key is ``changed`` and ``changed_columns`` names the
    columns; else what is left was ``deleted`` or ``inserted``, in ``copies``. Null keys are
    keys, and null equals null.
    """
    columns = new.columns
    sides = old.select(*columns, F.lit(-1).alias("_n")).unionAll(new.select(*columns, F.lit(1).alias("_n")))
    left = sides.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    whole = F.struct(*columns)
    per_key = left.groupBy(*keys).agg(
        F.sum(F.when(F.col("_n") < 0, -F.col("_n")).otherwise(0)).alias("_gone"),
        F.sum(F.when(F.col("_n") > 0, F.col("_n")).otherwise(0)).alias("_come"),
        F.max(F.when(F.col("_n") < 0, whole)).alias("_old"),
        F.max(F.when(F.col("_n") > 0, whole)).alias("_new"),
    )
    one_each = (F.col("_gone") == 1) & (F.col("_come") == 1)
    others = [c for c in columns if c not in keys]
    differing = F.array(
        *[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in others]
    )
    changed = per_key.filter(one_each).select(
        *keys,
        F.lit("changed").alias("change"),
        F.lit(1).cast("bigint").alias("copies"),
        F.array_join(F.array_compact(differing), ",").alias("changed_columns"),
    )
    rest = matching(left, per_key.filter(~one_each), keys)
    moved = rest.groupBy(*keys, F.when(F.col("_n") < 0, "deleted").otherwise("inserted").alias("change")).agg(
        F.sum(F.abs("_n")).alias("copies")
    )
    return changed.unionByName(moved.withColumn("changed_columns", F.lit("")))
