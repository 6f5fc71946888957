"""Rules across entities: values that must stand in another table.

Each rule looks up the distinct values, not the rows: they are made per partition before they are
shuffled, so a value that a third of the rows hold is one row per partition, and what fails comes
back to the rows as a look-up of the unknown values alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.operators.joins import enrich
from lakeconform.operators.quality import VIOLATIONS, Contract, Reference


def unknown_values(df: DataFrame, reference: Reference, parent: DataFrame) -> DataFrame:
    """Values that the parent lacks (``value``), with the rows that hold each (``n``)."""
    asked = df.groupBy(F.col(reference.column).alias("value")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(reference.target).alias("_known")).distinct()
    return asked.filter("value IS NOT NULL").join(known, F.col("value") == F.col("_known"), "left_anti")


def check_references(annotated: DataFrame, contract: Contract, parents: Mapping[str, DataFrame]) -> DataFrame:
    """An annotated frame whose violations also name the references that lead nowhere."""
    df = annotated
    for i, reference in enumerate(contract.references):
        lost = unknown_values(annotated, reference, parents[reference.parent])
        lost = lost.select("value", F.lit(reference.name).alias(f"_lost_{i}"))
        df = enrich(df, lost, {reference.column: "value"})
    if not contract.references:
        return df
    names = [f"_lost_{i}" for i in range(len(contract.references))]
    found = F.concat(VIOLATIONS, F.array_compact(F.array(*names)))
    return df.withColumn(VIOLATIONS, found).drop(*names)


def reference_failures(df: DataFrame, contract: Contract, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Per reference that fails: ``rule``, rows that fail (``failures``), different ``keys``."""
    counts = [
        unknown_values(df, reference, parents[reference.parent]).agg(
            F.lit(reference.name).alias("rule"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("failures"),
            F.count("*").alias("keys"),
        )
        for reference in contract.references
    ]
    if not counts:
        return df.sparkSession.createDataFrame([], "rule string, failures long, keys long")
    return reduce(DataFrame.unionByName, counts).filter("failures > 0")
