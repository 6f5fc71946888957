"""People and teams over time: who held which role when, overlaps, tenures, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeconform.functions import round_half_away
from lakeconform.operators.intervals import OPEN_END, load_spans, overlap_join
from lakeconform.operators.timelines import as_of_join, islands


def reporter_roles(achievements: DataFrame, membership: DataFrame) -> DataFrame:
    """Each achievement with its reporter's latest membership begun by the end of its month."""
    asked = achievements.select(
        "achievement_sk",
        "month_key",
        "reported_by",
        F.last_day(F.expr("try_to_date(month_key, 'yyyy-MM')")).alias("month_end"),
    )
    held = membership.select(
        F.col("employee_email").alias("reported_by"),
        "start_date",
        F.col("role").alias("role_then"),
        F.col("allocation_pct").alias("allocation_then"),
        F.col("team_id").alias("team_then"),
    )
    return as_of_join(
        asked, held, "reported_by", "month_end", "start_date", ["role_then", "allocation_then", "team_then"]
    )


def concurrent_leads(membership: DataFrame) -> DataFrame:
    """Pairs of teams that one person has led at the same time, with the days they shared."""
    leads = membership.filter("role = 'TEAM_LEAD'").select("employee_email", "team_id", "start_date", "end_date")
    pairs = overlap_join(
        leads, leads, ["employee_email"], "start_date", "end_date", F.col("l_team_id") < F.col("r_team_id")
    )
    return pairs.select(
        F.col("l_employee_email").alias("employee_email"),
        F.col("l_team_id").alias("team_id"),
        F.col("l_start_date").alias("start_date"),
        F.col("r_team_id").alias("other_team_id"),
        F.col("r_start_date").alias("other_start_date"),
        "overlap_start",
        "overlap_end",
    )


def overallocated_spans(membership: DataFrame) -> DataFrame:
    """Spans of days in which a person's allocations add up to more than all of their time."""
    return load_spans(membership, "employee_email", "start_date", "end_date", "allocation_pct", 100)


def tenures(membership: DataFrame) -> DataFrame:
    """Unbroken stretches of a person on any team; memberships a day apart are one stretch."""
    dated = membership.withColumn("until", F.coalesce("end_date", F.expr(OPEN_END))).filter("start_date <= until")
    return islands(
        dated, "employee_email", "start_date", "until", "1", [F.count("*").alias("memberships")], unit="year"
    )


def sessions(events: DataFrame, minutes: int = 30) -> DataFrame:
    """A user's events with no longer pause than the given minutes between them."""
    return islands(
        events,
        "user_id",
        "ts",
        "ts",
        f"INTERVAL {minutes} MINUTES",
        [F.count("*").alias("n_events"), round_half_away(F.sum("value"), 4).alias("total_value")],
        unit="day",
    )


def team_trends(monthly: DataFrame, months: int = 3) -> DataFrame:
    """Per team and month the mean of the last months and the change to the month before.

    A team's months are filled up from its first to its last, so that a month without
    achievements counts as none. The frames go over team-months, never over facts.
    """
    counts = monthly.filter("month_key IS NOT NULL").groupBy("team_id", "month_key").agg(
        F.sum("achievement_count").alias("achievements")
    )
    dated = counts.withColumn("month", F.to_date(F.concat("month_key", F.lit("-01"))))
    calendar = dated.groupBy("team_id").agg(F.min("month").alias("first"), F.max("month").alias("last"))
    calendar = calendar.select(
        "team_id", F.explode(F.expr("sequence(first, last, INTERVAL 1 MONTH)")).alias("month")
    )
    filled = calendar.join(dated, ["team_id", "month"], "left").select(
        "team_id",
        F.date_format("month", "yyyy-MM").alias("month_key"),
        (F.year("month") * 12 + F.month("month")).alias("number"),
        F.coalesce("achievements", F.lit(0)).cast("bigint").alias("achievements"),
    )
    in_time = Window.partitionBy("team_id").orderBy("number")
    recent = in_time.rangeBetween(1 - months, 0)
    return filled.select(
        "team_id",
        "month_key",
        "achievements",
        round_half_away(F.avg("achievements").over(recent), 4).alias("recent_mean"),
        (F.col("achievements") - F.lag("achievements").over(in_time)).alias("change"),
    )


def workforce_rollup(members: DataFrame) -> DataFrame:
    """Memberships and people by region, country, city and staff type, with all subtotals.

    Memberships are first counted per person, people then per place; only those few rows are
    repeated for the subtotals. A person has one place and one staff type, so people of
    different cells are different people and their numbers add up.
    """
    place = ["person_region", "person_country", "person_city", "staff_type"]
    per_person = members.groupBy(*place, "employee_email").agg(F.count("*").alias("memberships"))
    cells = per_person.groupBy(*place).agg(
        F.count("employee_email").alias("people"), F.sum("memberships").alias("memberships")
    )
    return cells.rollup(*place).agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("people").alias("people"),
        F.sum("memberships").alias("memberships"),
    )
