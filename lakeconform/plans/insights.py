"""Analyst queries over the curated datasets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.functions import round_half_away, stable_round


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, round_half_away(part / whole, 4))


def _flag_sum(name: str) -> Column:
    return F.count_if(F.coalesce(F.col(name), F.lit(False)))


def n01_roster_overview(members: DataFrame) -> DataFrame:
    teams = F.count_distinct("team_id")
    return members.agg(
        teams.alias("teams"),
        F.count("*").alias("membership_rows"),
        F.count_distinct("employee_email").alias("distinct_people"),
        F.when(teams > 0, round_half_away(F.count("*") / teams, 1)).alias("mean_team_size"),
    )


def n02_team_roster(members: DataFrame, team_id: str | None = None) -> DataFrame:
    """The roster of one team, by default the one with the lowest id."""
    wanted = F.lit(team_id) if team_id else members.agg(F.min("team_id")).scalar()
    return (
        members.filter(F.col("team_id") == wanted)
        .select(
            "team_id",
            "team_name",
            "full_name",
            "employee_email",
            "role",
            "staff_type",
            "person_city",
            "allocation_pct",
            "is_active",
        )
        .orderBy("role", F.col("full_name").asc_nulls_last(), "employee_email")
    )


def n03_team_size_distribution(members: DataFrame) -> DataFrame:
    sizes = members.groupBy("team_id").agg(F.count("*").alias("team_size"))
    return sizes.groupBy("team_size").agg(F.count("*").alias("teams"))


def n04_workforce_composition(members: DataFrame) -> DataFrame:
    return members.groupBy("staff_type").agg(F.count("*").alias("people"))


def n05_location_overview(locations: DataFrame) -> DataFrame:
    return locations.agg(
        F.count_distinct("primary_office").alias("offices"),
        _flag_sum("is_distributed").alias("distributed_teams"),
        _share(_flag_sum("is_distributed"), F.count("*")).alias("distributed_share"),
        _flag_sum("office_matches_members").alias("office_matches"),
    )


def n06_office_breakdown(locations: DataFrame) -> DataFrame:
    """Offices whose code has no location do not show here."""
    return (
        locations.filter("office_region IS NOT NULL AND office_city IS NOT NULL")
        .groupBy("office_region", "office_city")
        .agg(
            F.count("team_id").alias("teams"),
            F.coalesce(F.sum("member_count"), F.lit(0)).alias("members"),
        )
    )


def n07_teams_per_place(locations: DataFrame) -> DataFrame:
    """Teams per city and per region, both from one scan."""
    kinds = F.array(
        F.struct(F.lit("city").alias("kind"), F.col("office_city").alias("place")),
        F.struct(F.lit("region").alias("kind"), F.col("office_region").alias("place")),
    )
    return (
        locations.select(F.inline(kinds))
        .filter("place IS NOT NULL")
        .groupBy("kind", "place")
        .agg(F.count("*").alias("teams"))
    )


def n08_achievement_overview(achievements: DataFrame) -> DataFrame:
    return achievements.agg(
        F.count_distinct("month_key").alias("months"),
        F.min("month_key").alias("first_month"),
        F.max("month_key").alias("last_month"),
        F.count("*").alias("team_months"),
        F.coalesce(F.sum("achievement_count"), F.lit(0)).alias("achievements"),
        stable_round(F.avg("avg_impact_score_numeric"), 2).alias("mean_impact_numeric"),
    )


def n09_monthly_rollup(achievements: DataFrame) -> DataFrame:
    return achievements.groupBy("month_key").agg(
        F.sum("achievement_count").alias("achievements"),
        F.count_distinct("team_id").alias("teams_reporting"),
        stable_round(F.avg("avg_impact_score_numeric"), 2).alias("avg_impact"),
    )


def n10_top_teams_by_impact(achievements: DataFrame, k: int = 10) -> DataFrame:
    return (
        achievements.filter("team_id IS NOT NULL AND team_name IS NOT NULL")
        .groupBy("team_id", "team_name")
        .agg(
            F.sum("achievement_count").alias("achievements"),
            round_half_away(F.coalesce(F.sum("total_impact_score"), F.lit(0.0)), 2).alias("total_impact"),
        )
        .orderBy(F.col("total_impact").desc(), "team_id", "team_name")
        .limit(k)
    )


def n11_colocation_overview(colocation: DataFrame) -> DataFrame:
    apart = _flag_sum("leader_not_colocated")
    return colocation.agg(
        F.count("*").alias("teams"),
        apart.alias("not_colocated"),
        _share(apart, F.count("*")).alias("not_colocated_share"),
        F.count_if(~F.col("is_colocated_with_office")).alias("not_at_office"),
        F.count_if(F.col("is_colocated_with_members").isNull()).alias("undetermined"),
        F.count_if("is_colocated_with_members").alias("colocated"),
    )


def n12_leaders_by_staff_type(leaders: DataFrame) -> DataFrame:
    return leaders.groupBy("leader_staff_type").agg(F.count("*").alias("teams"))


def n13_leader_agencies(leaders: DataFrame) -> DataFrame:
    return (
        leaders.filter(F.col("leader_is_non_direct") & F.col("leader_agency").isNotNull())
        .groupBy(F.col("leader_agency").alias("agency"))
        .agg(F.count("*").alias("teams_led"))
    )


def n14_ratio_overview(ratios: DataFrame) -> DataFrame:
    """Mean, exact median and maximum. The share has four decimals, so the exact percentile
    keeps at most 10,001 distinct values."""
    above = _flag_sum("exceeds_threshold")
    share = F.col("non_direct_ratio")
    return ratios.agg(
        F.count("*").alias("teams"),
        above.alias("above_threshold"),
        _share(above, F.count("*")).alias("above_share"),
        stable_round(F.avg(share), 4).alias("mean_ratio"),
        round_half_away(F.percentile(share, 0.5), 5).alias("median_ratio"),
        F.max(share).alias("max_ratio"),
    )


def n15_top_teams_by_ratio(ratios: DataFrame, k: int = 10) -> DataFrame:
    return (
        ratios.filter("non_direct_ratio IS NOT NULL")
        .select(
            "team_id",
            "team_name",
            "member_count",
            "direct_count",
            "non_direct_count",
            "non_direct_ratio",
        )
        .orderBy(F.col("non_direct_ratio").desc(), "team_id", F.col("team_name").asc_nulls_last())
        .limit(k)
    )


def n16_ratio_histogram(ratios: DataFrame, bins: int = 30) -> DataFrame:
    """Teams per equal-width bin from the lowest to the highest share; the last bin is closed.

    Shares are counted per distinct value first (four decimals), then binned.
    """
    counted = (
        ratios.filter("non_direct_ratio IS NOT NULL")
        .groupBy(F.col("non_direct_ratio").alias("share"), "exceeds_threshold")
        .agg(F.count("*").alias("n"))
    )
    low, high = counted.agg(F.min("share")).scalar(), counted.agg(F.max("share")).scalar()
    # A single value gets a range of one around it, as a histogram of one value would show it.
    spread = F.when(high > low, high - low).otherwise(F.lit(1.0))
    start = F.when(high > low, low).otherwise(low - 0.5)
    bin_number = F.least(
        F.floor((F.col("share") - start) * F.lit(float(bins)) / spread) + 1, F.lit(bins)
    )
    return (
        counted.select(bin_number.cast("int").alias("bin"), "n", "exceeds_threshold")
        .groupBy("bin")
        .agg(
            F.sum("n").alias("teams"),
            F.sum(F.when(F.col("exceeds_threshold"), F.col("n")).otherwise(0)).alias("above"),
            F.sum(F.when(~F.col("exceeds_threshold"), F.col("n")).otherwise(0)).alias("not_above"),
        )
    )


def n16_threshold_split(ratios: DataFrame) -> DataFrame:
    """Teams above the threshold, and all the others."""
    return ratios.groupBy(
        F.coalesce(F.col("exceeds_threshold"), F.lit(False)).alias("above_threshold")
    ).agg(F.count("*").alias("teams"))


def n17_reporting_claims(orgs: DataFrame) -> DataFrame:
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    claimed, verified = total("teams_claiming_org_leader"), total("teams_verified_org_leader")
    return orgs.agg(
        claimed.alias("claimed"),
        verified.alias("verified"),
        total("teams_claim_unverified").alias("unverified"),
        (claimed - verified).alias("overstated_by"),
    )


def n18_dataset_inventory(gold: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in gold.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def n19_attribution_recovery(achievements: DataFrame) -> DataFrame:
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return achievements.agg(
        total("achievement_count").alias("achievements"),
        total("attributed_via_reporter").alias("attributed_via_reporter"),
    )


def n20_answer_consistency(answers: DataFrame, gold: Mapping[str, DataFrame]) -> DataFrame:
    """Stored headline against a fresh count, for the questions that can be recounted."""
    checks = {
        "Q1": (gold["team_members"], F.count_distinct("team_id")),
        "Q4": (gold["leader_not_colocated"], _flag_sum("leader_not_colocated")),
        "Q5": (gold["leader_non_direct_staff"], _flag_sum("leader_is_non_direct")),
        "Q6": (gold["staff_ratio_analysis"], _flag_sum("exceeds_threshold")),
        "Q7": (
            gold["organization_reporting_summary"],
            F.coalesce(F.sum("teams_verified_org_leader"), F.lit(0)),
        ),
    }
    fresh = reduce(
        DataFrame.unionByName,
        [
            df.agg(value.cast("long").alias("recomputed")).select(
                F.lit(question).alias("question_id"), "recomputed"
            )
            for question, (df, value) in checks.items()
        ],
    )
    stored = answers.select("question_id", F.col("answer").alias("stored"))
    return fresh.join(stored, "question_id", "left").withColumn(
        "matches", F.coalesce(F.col("stored") == F.col("recomputed"), F.lit(False))
    )


def assert_consistent(consistency: DataFrame) -> None:
    """Raise if a stored answer differs from its recount. At most five rows reach the driver."""
    wrong = [row.question_id for row in consistency.filter("NOT matches").collect()]
    if wrong:
        raise ValueError(f"stored answers differ from their recount: {sorted(wrong)}")
