"""Time the headline queries and one full run; print one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Every query is computed in full into
Spark's no-op sink. The run writes the derived exports as CSV and JSON first (not timed),
"""

from __future__ import annotations

import json
import os
import tempfile
import time
import uuid
from datetime import date

from pyspark.sql import SparkSession

from lakeconform.catalog import queries as catalog
from lakeconform.catalog.projection import raw_frame, table
from lakeconform.plans.pipeline import run_pipeline
from lakeconform.settings import Settings
from lakeconform.sources.lake import Lake
from lakeconform.sources.registry import SOURCES, Origin

HEADLINES = (
    "conform_employees",
    "conform_teams",
    "conform_team_membership",
    "rejected_team_membership",
    "conform_achievements",
    "dim_person",
    "team_members",
    "team_locations",
    "monthly_team_achievements",
    "leader_not_colocated",
    "leader_non_direct_staff",
    "staff_ratio_analysis",
    "organization_reporting_summary",
    "employee_summary",
    "business_answers",
)


def build_session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def write_exports(spark: SparkSession, sf_dir: str, root: str) -> None:
    for source in SOURCES:
        df = raw_frame(lambda name: table(spark, sf_dir, name), source.entity)
        path = f"{root}/{source.system}/{source.file_name}"
        if source.file_format == "csv":
            df.write.option("header", "true").option("escape", '"').csv(path)
        else:
            df.write.option("ignoreNullFields", "false").json(path)


def full_run(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    """A full run over the exports: seconds and rows per stage and per hop."""
    # BENCH_LAKE is a folder all executors share; only a local master may do without it.
    shared = os.environ.get("BENCH_LAKE")
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise SystemExit("set BENCH_LAKE to a shared folder")
    work = f"{shared}/run-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="run-", dir="/tmp")
    write_exports(spark, sf_dir, f"{work}/raw")
    started = time.perf_counter()
    report = run_pipeline(
        spark,
        Lake(f"{work}/lake"),
        Origin(f"{work}/raw"),
        Settings(as_of=date(2024, 2, 1)),
        route="file",
    )
    total = time.perf_counter() - started
    seconds, rows = {"run_total": round(total, 3)}, {}
    for hop in report.metrics.select("layer", "entity", "duration_s", "rows_read").collect():
        for name in (f"run_{hop.layer}", f"hop_{hop.layer}_{hop.entity}"):
            seconds[name] = round(seconds.get(name, 0) + hop.duration_s, 3)
            rows[name] = rows.get(name, 0) + hop.rows_read
    return seconds, rows


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(os.environ.get("BENCH_CPUS", "8"))
    registered = catalog.queries()
    registered["clean_string"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in HEADLINES:
        started = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    run_seconds, run_rows = full_run(spark, sf_dir)
    timings |= run_seconds
    print(
        json.dumps(
            {
                "metric": "seconds for headline queries and one full run",
                "value": round(sum(timings[n] for n in (*HEADLINES, "run_total")), 3),
                "unit": "sec",
                "queries": timings,
                "rows": run_rows,
                "sf": sf_dir.rstrip("/").rsplit("/", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
