"""One record per person, and the most common value per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.operators.dedup import keep_first, surplus_rows
from lakeconform.operators.quality import mark_rejected

DIRECT = "DIRECT"
NON_DIRECT = "NON_DIRECT"
PERSON_COLLISION = "duplicate_email_lower_precedence"


def person_candidates(employees: DataFrame, contractors: DataFrame) -> DataFrame:
    """Both people sources in one shape, without rows that have no address."""
    direct = employees.selectExpr(
        "emp_id AS person_id",
        "email",
        "full_name",
        "location_code",
        "status",
        f"'{DIRECT}' AS staff_type",
        "'employee_directory' AS person_source",
        "department",
        "CAST(NULL AS STRING) AS agency",
        *_batch(employees),
    )
    vendor = contractors.selectExpr(
        "contractor_id AS person_id",
        "email",
        "full_name",
        "location_code",
        "status",
        f"'{NON_DIRECT}' AS staff_type",
        "'vendor_management' AS person_source",
        "CAST(NULL AS STRING) AS department",
        "agency",
        *_batch(contractors),
    )
    return direct.unionByName(vendor, allowMissingColumns=True).filter("email IS NOT NULL")


def _batch(df: DataFrame) -> list[str]:
    return ["_batch_id"] if "_batch_id" in df.columns else []


# Directory before vendor, active before inactive, then the lower id.
PERSON_ORDER = ("staff_type", "IF(status = 'ACTIVE', 0, 1)", "person_id")


def people_of(candidates: DataFrame) -> DataFrame:
    return keep_first(candidates, ["email"], PERSON_ORDER)


def collisions_of(candidates: DataFrame) -> DataFrame:
    return mark_rejected(surplus_rows(candidates, ["email"], PERSON_ORDER), PERSON_COLLISION)


def unify_people(employees: DataFrame, contractors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(people, collisions)``: one row per address, and the rows that lost their address."""
    candidates = person_candidates(employees, contractors)
    return people_of(candidates), collisions_of(candidates)


def dominant_value(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    value_name: str | None = None,
    count_name: str = "headcount",
) -> DataFrame:
    """Most frequent non-null value per group; the smaller value wins a tie.

    Both steps are partial aggregates: no window and no task holds a whole group.
    """
    known = df.filter(F.col(value).isNotNull())
    counts = known.groupBy(*group, value).agg(F.count("*").alias("_n"))
    best = counts.groupBy(*group).agg(F.min(F.struct((-F.col("_n")).alias("_rarity"), F.col(value))).alias("_best"))
    return best.select(
        *group,
        F.col(f"_best.{value}").alias(value_name or value),
        (-F.col("_best._rarity")).alias(count_name),
    )
