"""Look-up joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Left join to a frame that is unique on the key; the key columns of ``right`` are dropped.

    ``on`` maps left columns to right columns; other right names must differ from the left
    ones. There is no broadcast hint: Spark broadcasts the right side if its size, estimated
    or measured while running, is within ``spark.sql.autoBroadcastJoinThreshold``, and
    shuffles otherwise.

    In the shuffled form a frequent key, and the rows without a key, are split by adaptive
    skew handling. That works only if both sides reach the join straight from a shuffle,
    which a right side already partitioned by an aggregate or window on the same key would
    not. Comparing a hash of the key as well makes it take its own shuffle.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {name: name for name in on}
    theirs = [f"_on_{name}" for name in pairs.values()]
    others = [name for name in right.columns if name not in pairs.values()]
    keyed = right.selectExpr(
        *[f"`{name}` AS `_on_{name}`" for name in pairs.values()], *[f"`{n}`" for n in others]
    )
    equal = " AND ".join(f"`{a}` = `{b}`" for a, b in zip(pairs, theirs, strict=True))
    hashed = f"xxhash64(`{'`, `'.join(pairs)}`) = xxhash64(`{'`, `'.join(theirs)}`)"
    return left.join(keyed, F.expr(f"{equal} AND {hashed}"), "left").drop(*theirs)
