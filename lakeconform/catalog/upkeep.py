"""Queries of rules across entities, of sketches kept per day, and of streams over the events."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeconform.operators.sketches import PEOPLE_BOUND, RANK_BOUND, estimate, merge, sketches
from lakeconform.plans.references import REFERENCES, adrift, all_failures
from lakeconform.settings import Settings
from lakeconform.streaming.windows import closed_windows, event_stream, run_windows

QUANTILES = {"median": 0.5, "upper": 0.95}
DELAY = "1 hour"


def work_folder(spark: SparkSession) -> str:
    """A new folder that all executors share; only a session on one machine may do without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lakeconform-")
    path = f"{root.rstrip('/')}/lakeconform-work/{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def weekly_sketches(events: DataFrame) -> DataFrame:
    """Weeks merged from daily sketches, and whether they are as near the truth as they must be."""
    day, week = F.date_trunc("day", "ts"), F.date_trunc("week", "ts")
    daily = sketches(events, [day.alias("day")], "user_id", "value")
    weekly = merge(daily, [F.date_trunc("week", "day").alias("week")])
    told = estimate(weekly, QUANTILES)
    ranks = [
        F.count_if(F.col("value") < F.col(name)).alias(f"{name}_below") for name in QUANTILES
    ] + [F.count_if(F.col("value") <= F.col(name)).alias(f"{name}_up_to") for name in QUANTILES]
    facts = events.select(week.alias("week"), "user_id", "value").join(told, "week")
    truth = facts.groupBy("week", "rows", "distinct_values").agg(
        F.countDistinct("user_id").alias("people"), F.count("value").alias("n"), *ranks
    )
    near = [
        (
            (F.col(f"{name}_below") <= F.col("n") * (q + RANK_BOUND))
            & (F.col(f"{name}_up_to") >= F.col("n") * (q - RANK_BOUND))
        ).alias(f"{name}_within")
        for name, q in QUANTILES.items()
    ]
    people = F.abs(F.col("distinct_values") - F.col("people")) <= PEOPLE_BOUND * F.col("people")
    return truth.select("week", "rows", "people", people.alias("people_within"), *near)


def _streamed(frames, keys: list[str], length: str, session: bool = False) -> DataFrame:
    """The windows that the watermark has closed when all files of ``events`` are read."""
    work = work_folder(frames.spark)
    # A pattern, since a stream's plain path must be a folder, and the table may be one file.
    events = event_stream(frames.spark, f"{frames.sf_dir}/events.parque[t]", frames.table("events").schema)
    # Clock times are taken as UTC, so that days do not depend on the session's zone.
    zone = F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.lit("UTC")).alias("ts")
    windows = closed_windows(
        events.select(zone, "event_id", *keys, "value"),
        keys,
        time="ts",
        identity="event_id",
        value="value",
        length=length,
        delay=DELAY,
        session=session,
    )
    run_windows(windows, f"{work}/windows", f"{work}/checkpoint")
    return frames.spark.read.schema(windows.schema).parquet(f"{work}/windows")


_CLOSED = f"(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {DELAY} FROM events)"
_ONCE = "(SELECT DISTINCT ON (event_id) * FROM events WHERE ts IS NOT NULL)"
_WINDOWS_SQL = f"""
WITH days AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS starts, event_type, count(*) AS n, round(sum(value), 4) AS total
  FROM {_ONCE} GROUP BY 1, 2
)
SELECT *, starts + INTERVAL 1 DAY AS ends FROM days WHERE starts + INTERVAL 1 DAY <= {_CLOSED}
"""
_SESSIONS_SQL = f"""
WITH gaps AS (
  SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTES, true) AS first
  FROM {_ONCE}
),
runs AS (SELECT *, count(*) FILTER (first) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM gaps)
SELECT min(ts) AS starts, max(ts) + INTERVAL 30 MINUTES AS ends, user_id, count(*) AS n,
  round(sum(value), 4) AS total
FROM runs GROUP BY user_id, run HAVING max(ts) + INTERVAL 30 MINUTES <= {_CLOSED}
"""
_SKETCHES_SQL = """
SELECT date_trunc('week', ts)::TIMESTAMP AS week, count(*) AS rows, count(DISTINCT user_id) AS people,
  true AS people_within, true AS median_within, true AS upper_within
FROM events WHERE ts IS NOT NULL GROUP BY 1
"""


def _silver(entity: str) -> str:
    return "people" if entity == "dim_person" else f"silver_{entity}"


def _lost(reference) -> str:
    return (
        f"c.{reference.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {_silver(reference.parent)} p "
        f"WHERE p.{reference.target} = c.{reference.column})"
    )


def _failures_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, '{r.name}' AS rule, count(*) AS failures, count(DISTINCT c.{r.column}) AS keys "
        f"FROM silver_{entity} c WHERE {_lost(r)} HAVING count(*) > 0"
        for entity, references in REFERENCES.items()
        for r in references
    )


def _adrift_sql(entity: str, columns: str) -> str:
    names = ", ".join(f"CASE WHEN {_lost(r)} THEN '{r.name}' END" for r in REFERENCES[entity])
    found = f"SELECT {columns}, concat_ws('; ', {names}) AS _rejection_reason FROM silver_{entity} c"
    return f"SELECT * FROM ({found}) WHERE _rejection_reason <> ''"


def register_all(register: Callable, settings: Settings) -> None:
    register("reference_failures", lambda f: all_failures(f.silver, settings), _failures_sql())
    for entity, columns in (
        ("team_membership", "team_id, employee_email, role, start_date"),
        ("teams", "team_id, org_id, team_leader_email, reporting_manager_email"),
    ):
        register(
            f"adrift_{entity}",
            lambda f, entity=entity, columns=columns: adrift(
                entity, lambda name: f.settled(name) if name == entity else f.silver(name), settings
            ).select(
                *columns.split(", "), "_rejection_reason"
            ),
            _adrift_sql(entity, columns),
        )
    register("weekly_sketches", lambda f: weekly_sketches(f.table("events").filter("ts IS NOT NULL")), _SKETCHES_SQL)
    register("stream_event_windows", lambda f: _streamed(f, ["event_type"], "1 day"), _WINDOWS_SQL)
    register(
        "stream_user_sessions", lambda f: _streamed(f, ["user_id"], "30 minutes", session=True), _SESSIONS_SQL
    )
