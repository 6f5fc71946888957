"""Tables read and written over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakeconform.sources.files import stringify_all

BATCH_SIZE = 10_000


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; with a partition column the table is read in parallel ranges.

    The bounds only shape the ranges. Rows outside them fall into the outer ranges.
    """
    options = {"url": url, "dbtable": table, **(properties or {})}
    given = [partition_column is not None, bounds is not None, num_partitions is not None]
    if any(given):
        if not all(given):
            raise ValueError("partition_column, bounds and num_partitions go together")
        low, high = bounds
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(num_partitions),
        }
    return options


def write_options(
    url: str, table: str, properties: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Writer options; overwriting keeps the table with its grants and indexes."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(BATCH_SIZE),
        "truncate": "true",
        **(properties or {}),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    options = read_options(url, table, partition_column, bounds, num_partitions, properties)
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
) -> None:
    df.write.format("jdbc").options(**write_options(url, table, properties)).mode(mode).save()


def count_rows(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None
) -> int:
    """Row count, counted by the database."""
    query = f"(SELECT COUNT(*) AS n FROM {table}) counted"
    return int(read_jdbc(spark, url, query, properties=properties).first()[0])


def seed_if_empty(
    df: DataFrame,
    url: str,
    table: str,
    force: bool = False,
    properties: Mapping[str, str] | None = None,
) -> int:
    """Fill a staging table from an export, all columns as text. Returns rows written,
    0 when the table already has rows and ``force`` is off."""
    spark = df.sparkSession
    if not force and count_rows(spark, url, table, properties) > 0:
        return 0
    write_jdbc(stringify_all(df), url, table, properties=properties)
    return count_rows(spark, url, table, properties)
