"""Row-count reconciliation and quality gates over the metrics of a run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeconform.functions import round_half_away

METRIC_SCHEMA = (
    "batch_id string, ingest_date string, layer string, entity string, source_path string, "
    "target_path string, rows_read long, rows_valid long, rows_quarantined long, "
    "rows_written long, status string, error string, started_at timestamp, ended_at timestamp, "
    "duration_s double, is_aggregate boolean, notes string"
)


def quarantine_share() -> Column:
    """Share of the rows read that were quarantined; zero when nothing was read."""
    read = F.col("rows_read")
    return F.when(read > 0, F.col("rows_quarantined") / read).otherwise(0.0)


def reconciles() -> Column:
    """Written plus quarantined rows equal the rows read. Aggregates and empty inputs pass."""
    accounted = F.col("rows_written") + F.col("rows_quarantined") == F.col("rows_read")
    return F.col("is_aggregate") | (F.col("rows_read") == 0) | accounted


def stage_metrics(
    spark: SparkSession, rows: Iterable[Mapping], is_local: bool = False, engine: str = "spark"
) -> DataFrame:
    """One row per stage and entity (some dozens per run) with its derived columns."""
    names = [part.split()[0] for part in METRIC_SCHEMA.split(", ")]
    data = [tuple(row.get(name) for name in names) for row in rows]
    return (
        spark.createDataFrame(data, METRIC_SCHEMA)
        .withColumn("is_local", F.lit(is_local))
        .withColumn("engine", F.lit(engine))
        .withColumn("quarantine_ratio", round_half_away(quarantine_share(), 6))
        .withColumn("reconciles", reconciles())
    )


def reconcile(metrics: DataFrame) -> DataFrame:
    """Every metric row with its verdict."""
    return metrics.withColumn("reconciles", reconciles())


def quarantine_gate(
    metrics: DataFrame, tolerances: Mapping[str, float], default: float = 0.25
) -> DataFrame:
    """Rows whose quarantine share is above the tolerance of their entity."""
    limits = [x for pair in tolerances.items() for x in (F.lit(pair[0]), F.lit(float(pair[1])))]
    limit = F.lit(float(default))
    if limits:
        limit = F.coalesce(F.try_element_at(F.create_map(*limits), F.col("entity")), limit)
    return (
        metrics.withColumn("tolerance", limit)
        .withColumn("quarantine_ratio", quarantine_share())
        .filter((F.col("rows_read") > 0) & (F.col("quarantine_ratio") > F.col("tolerance")))
        .withColumn("quarantine_ratio", round_half_away("quarantine_ratio", 6))
    )


def status_gate(metrics: DataFrame) -> DataFrame:
    """Rows that failed or were skipped. They read nothing, so they would reconcile."""
    return metrics.filter(F.col("status").isin("FAILED", "SKIPPED"))


def zero_row_gate(metrics: DataFrame) -> DataFrame:
    """Rows that report success but wrote nothing."""
    return metrics.filter((F.col("status") == "SUCCESS") & (F.col("rows_written") == 0))


def gate_findings(
    metrics: DataFrame,
    tolerances: Mapping[str, float],
    default: float = 0.25,
    fail_on_zero_rows: bool = True,
) -> DataFrame:
    """All findings of a run as (gate, layer, entity); a run passes when there are none."""

    def labelled(df: DataFrame, gate: str) -> DataFrame:
        return df.select(F.lit(gate).alias("gate"), "layer", "entity")

    found = (
        labelled(status_gate(metrics), "status")
        .unionByName(labelled(quarantine_gate(metrics, tolerances, default), "quarantine"))
        .unionByName(labelled(reconcile(metrics).filter("NOT reconciles"), "reconcile"))
    )
    if fail_on_zero_rows:
        found = found.unionByName(labelled(zero_row_gate(metrics), "zero_rows"))
    return found


def write_manifest(metrics: DataFrame, path: str) -> None:
    """Append a run's metrics under its batch id; a rerun of the batch replaces its own part."""
    (
        metrics.coalesce(1)  # a few dozen rows
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def run_summary(manifest: DataFrame) -> DataFrame:
    """The per-entity table of a run."""
    verdict = F.when(F.col("reconciles"), "OK").otherwise("MISMATCH")
    return manifest.select(
        "batch_id",
        "layer",
        "entity",
        "rows_read",
        "rows_valid",
        "rows_quarantined",
        "rows_written",
        "duration_s",
        verdict.alias("reconciliation"),
        "status",
        "error",
    ).orderBy("batch_id", F.col("layer"), "entity")
