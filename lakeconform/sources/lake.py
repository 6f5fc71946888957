"""Lake layout, lineage stamps, and writes that a rerun can repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeconform.sources.registry import Source, get_source

# Lineage columns carried by every row.
LINEAGE = (
    "_batch_id",
    "_ingested_at",
    "_processed_at",
    "_source_system",
    "_source_entity",
    "_source_file",
    "_source_layer",
)


@dataclass(frozen=True)
class Lake:
    """Paths under one shared root."""

    root: str

    def bronze(self, source: Source) -> str:
        return f"{self.root}/bronze/{source.system}/{source.entity}"

    def silver(self, entity: str) -> str:
        return f"{self.root}/silver/{entity}"

    def gold(self, dataset: str) -> str:
        return f"{self.root}/gold/{dataset}"

    def quarantine(self, layer: str, entity: str, batch_id: str) -> str:
        return f"{self.root}/quarantine/{layer}/{entity}/batch_id={batch_id}"

    def manifest(self) -> str:
        return f"{self.root}/lineage/manifest"

    def changes(self, source: Source, batch_id: str) -> str:
        """The raw rows that one incremental run has loaded."""
        return f"{self.root}/changes/{source.system}/{source.entity}/load={batch_id}"

    def open_facts(self) -> str:
        """Achievements without a team of their own, by load, whatever became of them."""
        return f"{self.root}/silver_open/achievements"

    def marks(self) -> str:
        return f"{self.root}/lineage/watermarks"

    def edge(self, source: Source) -> str:
        """The loaded rows that the next load may meet again."""
        return f"{self.root}/lineage/edges/{source.entity}"


def business_columns(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name not in LINEAGE]


def stamp_bronze(
    df: DataFrame, system: str, entity: str, path: str, route: str, batch_id: str
) -> DataFrame:
    """Provenance of a raw row. Stamps left over from an earlier load are replaced."""
    return df.drop(*LINEAGE).withColumns(
        {
            "_batch_id": F.lit(batch_id),
            "_ingested_at": F.lit(datetime.now(timezone.utc).isoformat()),
            "_source_system": F.lit(system),
            "_source_entity": F.lit(entity),
            "_source_file": F.lit(path),
            "_source_layer": F.lit(route),
        }
    )


def stamp_silver(df: DataFrame, entity: str, system: str = "derived") -> DataFrame:
    """Batch and source file stay from bronze; the rest says what made the row now."""
    return df.withColumns(
        {
            "_source_layer": F.lit("bronze"),
            "_source_system": F.lit(system),
            "_source_entity": F.lit(entity),
            "_processed_at": F.current_timestamp(),
        }
    )


def stamp_gold(df: DataFrame, batch_id: str) -> DataFrame:
    return df.withColumns(
        {
            "_batch_id": F.lit(batch_id),
            "_processed_at": F.current_timestamp(),
            "_source_layer": F.lit("silver"),
        }
    )


def write_dataset(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    coalesce: int | None = None,
) -> None:
    frame = df if coalesce is None else df.coalesce(coalesce)
    writer = frame.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_bronze(df: DataFrame, lake: Lake, source: Source, ingest_date: str) -> str:
    """Replace exactly one ``ingest_date`` of an entity; other dates stay. Returns its path."""
    (
        df.withColumn("ingest_date", F.lit(ingest_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date")
        .parquet(lake.bronze(source))
    )
    return f"{lake.bronze(source)}/ingest_date={ingest_date}"


def read_bronze(
    spark: SparkSession, lake: Lake, source: Source | str, ingest_date: str | None = None
) -> DataFrame:
    """An entity with its ``ingest_date``, all dates or the given one."""
    root = lake.bronze(get_source(source) if isinstance(source, str) else source)
    if ingest_date is None:
        return spark.read.parquet(root)
    return spark.read.option("basePath", root).parquet(f"{root}/ingest_date={ingest_date}")


def read_silver(spark: SparkSession, lake: Lake, entity: str) -> DataFrame:
    return spark.read.parquet(lake.silver(entity)).drop("_bucket")


def read_gold(spark: SparkSession, lake: Lake, dataset: str) -> DataFrame:
    return spark.read.parquet(lake.gold(dataset)).drop("_bucket")


def count_written(spark: SparkSession, path: str) -> int:
    """Rows found at a path, from file footers; 0 when there is nothing to read."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0


def write_quarantine(
    df: DataFrame, lake: Lake, layer: str, entity: str, batch_id: str
) -> int:
    """Keep rejected rows of this batch and count what was kept.

    The rows are written in as many files as there are tasks; an empty batch leaves no rows.
    """
    path = lake.quarantine(layer, entity, batch_id)
    write_dataset(df, path)
    return count_written(df.sparkSession, path)


def stage_root(spark: SparkSession, lake: Lake) -> str:
    """The lake's own part of the cluster's shared folder, else a folder inside the lake."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return f"{lake.root}/_stage"
    return f"{shared}/lakeconform/{hashlib.sha256(lake.root.encode()).hexdigest()[:16]}"


def stage_path(spark: SparkSession, lake: Lake, batch_id: str) -> str:
    return f"{stage_root(spark, lake)}/batch_id={batch_id}"


def _folder(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, as Hadoop knows them."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def remove_stage(spark: SparkSession, lake: Lake, batch_id: str) -> None:
    """Delete the intermediate tables of one run."""
    store, path = _folder(spark, stage_path(spark, lake, batch_id))
    store.delete(path, True)


def forget_marks(spark: SparkSession, lake: Lake) -> None:
    """After a full load the next incremental run starts afresh."""
    store, path = _folder(spark, lake.marks())
    store.delete(path, True)


def snapshot_dates(spark: SparkSession, lake: Lake, source: Source) -> list[str]:
    """The ingest dates of a bronze entity in order, from the folder names; no row is read."""
    store, path = _folder(spark, lake.bronze(source))
    if not store.exists(path):
        return []
    names = [status.getPath().getName() for status in store.listStatus(path)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("ingest_date="))


def settle(df: DataFrame, lake: Lake, name: str, batch_id: str) -> DataFrame:
    """Write an intermediate frame to the shared folder and read it back.

    What several outputs are made from is then computed once and survives lost executors.
    """
    spark = df.sparkSession
    path = f"{stage_path(spark, lake, batch_id)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
