"""The nine curated datasets, as functions of conformed entities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.functions import default_label, guarded_ratio, stable_round, tristate_equal
from lakeconform.operators.attribution import RESOLVED
from lakeconform.operators.identity import DIRECT, NON_DIRECT
from lakeconform.operators.joins import enrich


def _prefixed(df: DataFrame, prefix: str, names: list[str]) -> DataFrame:
    return df.selectExpr(*[f"{name} AS {prefix}{name}" for name in names])


def team_members(
    membership: DataFrame, people: DataFrame, teams: DataFrame, locations: DataFrame
) -> DataFrame:
    """One row per membership, also where person or team are unknown."""
    who = _prefixed(
        people,
        "p_",
        ["email", "person_id", "full_name", "department", "agency", "staff_type", "status",
         "location_code"],
    )
    team = _prefixed(
        teams.withColumn("known", F.lit(True)),
        "t_",
        ["team_id", "team_name", "org_id", "org_name", "primary_office", "known"],
    )
    place = _prefixed(locations, "l_", ["location_code", "city", "country", "region"])
    joined = enrich(membership, who, {"employee_email": "p_email"})
    joined = enrich(joined, team, {"team_id": "t_team_id"})
    joined = enrich(joined, place, {"p_location_code": "l_location_code"})
    return joined.selectExpr(
        "team_id",
        "t_team_name AS team_name",
        "t_org_id AS org_id",
        "t_org_name AS org_name",
        "t_primary_office AS team_primary_office",
        "employee_email",
        "p_full_name AS full_name",
        "p_department AS department",
        "p_agency AS agency",
        "role",
        "coalesce(p_staff_type, 'UNKNOWN') AS staff_type",
        "p_status AS person_status",
        "p_location_code AS person_location_code",
        "l_city AS person_city",
        "l_country AS person_country",
        "l_region AS person_region",
        "allocation_pct",
        "allocation_was_capped",
        "start_date",
        "end_date",
        "is_active",
        "p_person_id IS NOT NULL AS person_found",
        "t_known IS NOT NULL AS team_found",
    )


def roster_resolution(members: DataFrame) -> DataFrame:
    """How many roster rows have no person, and how many no team."""
    return members.agg(
        F.count_if(~F.col("person_found")).alias("unresolved_people"),
        F.count_if(~F.col("team_found")).alias("memberships_without_team"),
    )


def member_spread(members: DataFrame) -> DataFrame:
    """Per team: size, where its members are, and where most of them are.

    Counted first per team and place, so that a large team is reduced before the shuffle
    and everything per team comes out of one small second step. A place has one country and one
    region, so their maximum is theirs and the first step is a plain hash aggregate.
    """
    code = F.col("person_location_code")
    per_place = members.groupBy("team_id", code).agg(
        F.count("*").alias("_n"),
        F.max("person_country").alias("_country"),
        F.max("person_region").alias("_region"),
    )
    best = F.min(F.when(code.isNotNull(), F.struct((-F.col("_n")).alias("_rarity"), code)))
    return per_place.groupBy("team_id").agg(
        F.sum("_n").alias("member_count"),
        F.count(code).alias("distinct_member_locations"),
        F.array_sort(F.collect_set("_country")).alias("member_countries"),
        F.array_sort(F.collect_set("_region")).alias("member_regions"),
        best.alias("_best"),
    ).select(
        "team_id",
        "member_count",
        "distinct_member_locations",
        "member_countries",
        "member_regions",
        F.col("_best.person_location_code").alias("dominant_member_location"),
        (-F.col("_best._rarity")).alias("dominant_location_headcount"),
    )


def _union_of(sets: str) -> Column:
    """Sorted union of the arrays in a group."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(sets))))


def team_locations(
    teams: DataFrame, locations: DataFrame, members: DataFrame, spread: DataFrame | None = None
) -> DataFrame:
    """Per team: its registered office, and where its people are.

    ``spread`` is ``member_spread(members)`` where it is at hand.
    """
    office = locations.select(
        "location_code",
        F.col("city").alias("office_city"),
        F.col("country").alias("office_country"),
        F.col("region").alias("office_region"),
        F.col("timezone").alias("office_timezone"),
    )
    base = teams.select("team_id", "team_name", "org_id", "org_name", "primary_office")
    return (
        enrich(base, office, {"primary_office": "location_code"})
        .join(member_spread(members) if spread is None else spread, "team_id", "left")
        .withColumn(
            "is_distributed", F.coalesce(F.col("distinct_member_locations"), F.lit(0)) > 1
        )
        .withColumn(
            "office_matches_members",
            tristate_equal("primary_office", "dominant_member_location"),
        )
    )


def monthly_achievements(achievements: DataFrame, teams: DataFrame) -> DataFrame:
    """Per team and month: counts, score means and totals, categories.

    Facts are summed per team id, own team name, month and category by plain hash aggregates,
    then per month with their categories, before they meet the teams: the join handles
    team-months instead of facts.
    """
    numeric = F.when(F.col("impact_source_type") == "NUMERIC", F.col("impact_score"))
    per_category = (
        achievements.withColumnRenamed("team_name", "a_name")
        .groupBy("team_id", "a_name", "month_key", "category")
        .agg(
            F.count("*").alias("n"),
            F.sum(numeric).alias("numeric_sum"),
            F.count(numeric).alias("numeric_n"),
            F.sum("impact_score").alias("score_sum"),
            F.count("impact_score").alias("score_n"),
            F.max("impact_score").alias("score_max"),
            F.count_if(F.col("impact_source_type") == "BAND").alias("banded"),
            F.count_if(F.col("team_id_origin") == RESOLVED).alias("resolved"),
        )
    )
    summed = ("n", "numeric_sum", "numeric_n", "score_sum", "score_n", "banded", "resolved")
    partial = per_category.groupBy("team_id", "a_name", "month_key").agg(
        *[F.sum(name).alias(name) for name in summed],
        F.max("score_max").alias("score_max"),
        F.collect_set("category").alias("sets"),
    )
    named = enrich(
        partial,
        _prefixed(teams, "t_", ["team_id", "team_name", "org_id", "org_name"]),
        {"team_id": "t_team_id"},
    )
    rolled = named.groupBy(
        "team_id",
        F.coalesce("t_team_name", "a_name").alias("team_name"),
        F.col("t_org_id").alias("org_id"),
        F.col("t_org_name").alias("org_name"),
        "month_key",
    ).agg(
        F.sum("n").alias("achievement_count"),
        F.sum("numeric_sum").alias("numeric_sum"),
        F.sum("numeric_n").alias("numeric_n"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("score_n").alias("score_n"),
        F.max("score_max").alias("max_impact_score"),
        _union_of("sets").alias("categories"),
        F.sum("banded").alias("banded_score_count"),
        F.sum("resolved").alias("attributed_via_reporter"),
    )
    return rolled.select(
        "team_id",
        "team_name",
        "org_id",
        "org_name",
        "month_key",
        "achievement_count",
        _mean("numeric_sum", "numeric_n").alias("avg_impact_score_numeric"),
        _mean("score_sum", "score_n").alias("avg_impact_score_all"),
        stable_round(F.col("score_sum"), 2).alias("total_impact_score"),
        "max_impact_score",
        F.size("categories").cast("long").alias("distinct_categories"),
        "categories",
        "banded_score_count",
        "attributed_via_reporter",
    )


def _mean(total: str, count: str) -> Column:
    return F.when(F.col(count) > 0, stable_round(F.col(total) / F.col(count), 3))


def _leaders(teams: DataFrame, people: DataFrame, names: list[str]) -> DataFrame:
    leader = _prefixed(people, "p_", ["email", "person_id", *names])
    return enrich(teams, leader, {"team_leader_email": "p_email"})


def leader_colocation(
    teams: DataFrame,
    people: DataFrame,
    locations: DataFrame,
    members: DataFrame,
    spread: DataFrame | None = None,
) -> DataFrame:
    """Per team: does the leader sit with the members, and at the registered office?

    The leader is looked up among all people, since a leader need not be on the roster.
    """
    place = locations.select(
        "location_code",
        F.col("city").alias("leader_city"),
        F.col("region").alias("leader_region"),
    )
    base = teams.select("team_id", "team_name", "team_leader_email", "primary_office")
    led = enrich(
        _leaders(base, people, ["location_code"]), place, {"p_location_code": "location_code"}
    )
    dominant = (member_spread(members) if spread is None else spread).select(
        "team_id", "dominant_member_location", "dominant_location_headcount"
    )
    with_members = tristate_equal("leader_location_code", "dominant_member_location")
    with_office = tristate_equal("leader_location_code", "team_primary_office")
    return (
        led.select(
            "team_id",
            "team_name",
            "team_leader_email",
            F.col("p_location_code").alias("leader_location_code"),
            "leader_city",
            "leader_region",
            F.col("primary_office").alias("team_primary_office"),
            F.col("p_person_id").isNotNull().alias("leader_resolved"),
        )
        .join(dominant, "team_id", "left")
        .withColumn("is_colocated_with_members", with_members)
        .withColumn("is_colocated_with_office", with_office)
        .withColumn("leader_not_colocated", ~F.col("is_colocated_with_members"))
    )


def leader_staff_type(teams: DataFrame, people: DataFrame) -> DataFrame:
    """Per team: is the leader direct staff?"""
    base = teams.select("team_id", "team_name", "org_id", "org_name", "team_leader_email")
    led = _leaders(base, people, ["full_name", "agency", "status", "staff_type"])
    return led.select(
        "team_id",
        "team_name",
        "org_id",
        "org_name",
        "team_leader_email",
        F.col("p_full_name").alias("leader_name"),
        F.col("p_agency").alias("leader_agency"),
        F.col("p_status").alias("leader_status"),
        default_label("p_staff_type", "UNRESOLVED").alias("leader_staff_type"),
        F.col("p_person_id").isNotNull().alias("leader_resolved"),
    ).withColumn("leader_is_non_direct", F.col("leader_staff_type") == NON_DIRECT)


def staff_ratio(members: DataFrame, threshold: float) -> DataFrame:
    """Per team: share of non-direct staff among classified members.

    The threshold is compared with the published, rounded share.
    """
    kind = F.col("staff_type")
    return (
        members.groupBy("team_id", "team_name", "org_id", "org_name")
        .agg(
            F.count("*").alias("member_count"),
            F.count_if(kind == DIRECT).alias("direct_count"),
            F.count_if(kind == NON_DIRECT).alias("non_direct_count"),
            F.count_if(kind == "UNKNOWN").alias("unknown_count"),
            F.count_if("is_active").alias("active_member_count"),
        )
        .withColumn("classified_count", F.col("direct_count") + F.col("non_direct_count"))
        .withColumn("non_direct_ratio", guarded_ratio("non_direct_count", "classified_count"))
        .withColumn("non_direct_to_direct_ratio", guarded_ratio("non_direct_count", "direct_count"))
        .withColumn("exceeds_threshold", F.col("non_direct_ratio") > F.lit(threshold))
        .withColumn("threshold_used", F.lit(threshold))
    )


def org_reporting(teams: DataFrame, organizations: DataFrame) -> DataFrame:
    """Per organization: reporting lines claimed, and those the reference data confirms.

    Sums over yes/no values that are all unknown are null, not zero.
    """
    claims = F.col("reports_to_type") == "Org Leader"
    manager = F.col("reporting_manager_email")
    verified = manager.isNotNull() & (manager == F.col("o_org_leader_email"))
    joined = enrich(
        teams.select("org_id", "org_name", "reporting_manager_email", "reports_to_type"),
        _prefixed(organizations, "o_", ["org_id", "org_name", "org_leader_email"]),
        {"org_id": "o_org_id"},
    )
    return (
        joined.groupBy(
            "org_id",
            F.coalesce("o_org_name", "org_name").alias("org_name"),
            F.col("o_org_leader_email").alias("org_leader_email"),
        )
        .agg(
            F.count("*").alias("team_count"),
            F.sum(claims.cast("int")).alias("teams_claiming_org_leader"),
            F.sum(verified.cast("int")).alias("teams_verified_org_leader"),
            F.sum((claims & ~verified).cast("int")).alias("teams_claim_unverified"),
            F.count_distinct("reports_to_type").alias("distinct_reporting_types"),
        )
        .withColumn("verified_share", guarded_ratio("teams_verified_org_leader", "team_count"))
    )


def workforce_summary(people: DataFrame, locations: DataFrame) -> DataFrame:
    """Headcount per department, staff type and location.

    A location code fixes its city, country and region, so people are counted first and the
    few totals are joined to the locations.
    """
    counted = people.groupBy(
        default_label("department", "UNASSIGNED").alias("department"),
        "staff_type",
        "location_code",
    ).agg(
        F.count("*").alias("headcount"),
        F.count_if(F.col("status") == "ACTIVE").alias("active_headcount"),
    )
    place = _prefixed(locations, "l_", ["location_code", "city", "country", "region"])
    return enrich(counted, place, {"location_code": "l_location_code"}).select(
        "department",
        "staff_type",
        "location_code",
        F.col("l_city").alias("city"),
        F.col("l_country").alias("country"),
        F.col("l_region").alias("region"),
        "headcount",
        "active_headcount",
    )


def _total(column: Column | str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def _answer(
    df: DataFrame, number: str, question: str, value: Column, unit: str, detail: Column
) -> DataFrame:
    return df.agg(value.cast("long").alias("answer"), detail.alias("detail")).select(
        F.lit(number).alias("question_id"),
        F.lit(question).alias("question"),
        "answer",
        F.lit(unit).alias("unit"),
        "detail",
    )


def _said(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def business_answers(gold: Mapping[str, DataFrame], threshold: float = 0.20) -> DataFrame:
    """The headline answer to each question: seven one-row aggregates, no driver loop.

    Fixed values: the question, unit and detail texts are part of the published dataset.
    """
    flag = lambda name: _total(F.col(name).cast("int"))
    parts = [
        _answer(
            gold["team_members"],
            "Q1",
            "Who are the members of each team?",
            F.count_distinct("team_id"),
            "teams with a roster",
            _said(F.count("*"), " membership rows in gold.team_members"),
        ),
        _answer(
            gold["team_locations"],
            "Q2",
            "Where are the teams located?",
            F.count_distinct("primary_office"),
            "distinct offices in use",
            _said(flag("is_distributed"), " teams span more than one location"),
        ),
        _answer(
            gold["monthly_team_achievements"],
            "Q3",
            "What are the key achievements of each team monthly?",
            F.count_distinct("month_key"),
            "months covered",
            _said(F.count("*"), " team-month rows in gold.monthly_team_achievements"),
        ),
        _answer(
            gold["leader_not_colocated"],
            "Q4",
            "How many teams have a team leader not co-located with team members?",
            flag("leader_not_colocated"),
            "teams",
            F.lit("leader location differs from the dominant member location"),
        ),
        _answer(
            gold["leader_non_direct_staff"],
            "Q5",
            "How many teams have a team leader who is non-direct staff?",
            flag("leader_is_non_direct"),
            "teams",
            F.lit("leader resolves to the vendor roster rather than the directory"),
        ),
        _answer(
            gold["staff_ratio_analysis"],
            "Q6",
            "How many teams have a non-direct staff ratio above 20%?",
            flag("exceeds_threshold"),
            "teams",
            F.lit(f"threshold {threshold:.0%}, ratio is non_direct / classified members"),
        ),
        _answer(
            gold["organization_reporting_summary"],
            "Q7",
            "How many teams report to an organisation leader?",
            _total("teams_verified_org_leader"),
            "teams",
            _said(
                "verified against organisation reference data; ",
                _total("teams_claiming_org_leader"),
                " teams claim it in the source",
            ),
        ),
    ]
    answers = parts[0]
    for part in parts[1:]:
        answers = answers.unionByName(part)
    return answers
