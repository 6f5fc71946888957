"""The registry: each name with its Spark frame and, beside it, the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lakeconform import functions as fn
from lakeconform.catalog import oracle as sql
from lakeconform.catalog import timelines, upkeep
from lakeconform.catalog.projection import raw_frame, table
from lakeconform.catalog.stage import staged
from lakeconform.operators.attribution import attribution_summary, unique_candidates
from lakeconform.operators.dedup import deduplicate
from lakeconform.operators.identity import (
    collisions_of,
    dominant_value,
    people_of,
    person_candidates,
)
from lakeconform.operators.quality import (
    VIOLATIONS,
    mark_rejected,
    outcome_totals,
    rule_failures,
    warning_counts,
)
from lakeconform.operators.snapshots import incremental, latest_snapshot, next_watermark
from lakeconform.plans import gates, insights, marts
from lakeconform.plans.contracts import contracts
from lakeconform.plans.entities import (
    NORMALIZERS,
    Conformed,
    achievement_facts,
    conform,
    normalize_achievements,
)
from lakeconform.settings import Settings
from lakeconform.sources.files import stringify_all
from lakeconform.sources.registry import get_source

SETTINGS = Settings(as_of=date(2024, 2, 1))
ENTITIES = tuple(sql.KEYS)
# Metric rows with a tolerance of their own.
EXCEPTIONS = {"red widget 1995-01": 0.9, "blue bolt 1996-05": 0.05}

Query = Callable[[SparkSession, str], DataFrame]


class Gold(dict):
    """The curated datasets by name, each put together when it is first asked for."""

    def __init__(self, frames: Frames) -> None:
        super().__init__()
        self.frames = frames

    def __missing__(self, dataset: str) -> DataFrame:
        f = self.frames
        build = {
            "team_members": lambda: f.members,
            "team_locations": lambda: marts.team_locations(
                f.silver("teams"), f.silver("locations"), f.members
            ),
            "monthly_team_achievements": lambda: marts.monthly_achievements(
                f.silver("achievements"), f.silver("teams")
            ),
            "leader_not_colocated": lambda: marts.leader_colocation(
                f.silver("teams"), f.silver("dim_person"), f.silver("locations"), f.members
            ),
            "leader_non_direct_staff": lambda: marts.leader_staff_type(
                f.silver("teams"), f.silver("dim_person")
            ),
            "staff_ratio_analysis": lambda: marts.staff_ratio(
                f.members, SETTINGS.ratio_threshold
            ),
            "organization_reporting_summary": lambda: marts.org_reporting(
                f.silver("teams"), f.silver("organizations")
            ),
            "employee_summary": lambda: marts.workforce_summary(
                f.silver("dim_person"), f.silver("locations")
            ),
        }
        self[dataset] = build[dataset]()
        return self[dataset]


@dataclass(frozen=True)
class Frames:
    """Every stage of the work over one set of tables, as lazy frames."""

    spark: SparkSession
    sf_dir: str
    _tables: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _silver: dict[str, DataFrame] = field(default_factory=dict, repr=False)
    _settled: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def raw(self, entity: str) -> DataFrame:
        return raw_frame(self.table, get_source(entity).entity)

    def normalized(self, entity: str) -> DataFrame:
        if entity == "achievements":
            # Who is on which team is the same before and after dedup, since both are in the key.
            on_teams = self.conformed("team_membership").outcome.valid
            return normalize_achievements(self.raw(entity), on_teams, self.silver("teams"), SETTINGS)
        return NORMALIZERS[entity](self.raw(entity), SETTINGS)

    def conformed(self, entity: str) -> Conformed:
        return conform(entity, self.normalized(entity), SETTINGS)

    def rejected(self, entity: str) -> DataFrame:
        """Rows that broke a rule and rows that lost their key, of typed rows written once."""
        return conform(entity, staged(self.normalized(entity)), SETTINGS).rejected

    def silver(self, entity: str) -> DataFrame:
        if entity not in self._silver:
            self._silver[entity] = (
                people_of(person_candidates(self.silver("employees"), self.silver("contractors")))
                if entity == "dim_person"
                else self.conformed(entity).kept
            )
        return self._silver[entity]

    def settled(self, entity: str) -> DataFrame:
        """The conformed rows, written once, for queries that use or filter them several times."""
        if entity not in self._settled:
            self._settled[entity] = staged(self.silver(entity))
        return self._settled[entity]

    def settle(self) -> Frames:
        """Write the roster once, for queries over several of the curated datasets."""
        if "members" not in self._settled:
            self._settled["members"] = self.__dict__["members"] = staged(self.members)
        return self

    @cached_property
    def members(self) -> DataFrame:
        return marts.team_members(
            self.silver("team_membership"),
            self.silver("dim_person"),
            self.silver("teams"),
            self.silver("locations"),
        )

    @cached_property
    def gold(self) -> Gold:
        return Gold(self)

    def run_metrics(self) -> DataFrame:
        """Metric rows per team name and month, so that the gates have rows to find."""
        rejected = F.size(VIOLATIONS) > 0
        scored = ~rejected & F.col("impact_score").isNotNull()
        counted = (
            self.conformed("achievements")
            .outcome.annotated.groupBy(
                F.concat_ws(" ", "team_name", fn.default_label("month_key", "?")).alias("entity")
            )
            .agg(
                F.count("*").alias("rows_read"),
                F.count_if(rejected).alias("rows_quarantined"),
                F.count_if(scored).alias("rows_written"),
            )
        )
        failed = (F.col("rows_written") == 0) & (F.col("rows_read") > 1)
        return counted.select(
            F.lit("silver").alias("layer"),
            "entity",
            "rows_read",
            "rows_quarantined",
            "rows_written",
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.lit(False).alias("is_aggregate"),
        )


def _plain_arrays(df: DataFrame) -> DataFrame:
    """Arrays as joined text, so that both engines show them alike."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]
    return df.withColumns({name: F.array_join(name, ",") for name in arrays})


_QUERIES: dict[str, Query] = {}
_CHECKS: dict[str, str] = {}


def register(name: str, build: Callable[[Frames], DataFrame], check: str) -> None:
    _QUERIES[name] = lambda spark, sf_dir: _plain_arrays(build(Frames(spark, sf_dir)))
    _CHECKS[name] = sql.with_steps(check)


# Column functions (B1-B25), each over a whole export or table


def _scalar(name: str, entity: str, keys: str, columns: dict[str, tuple[Callable[[], Column], str]]) -> None:
    given = keys.split()
    raw_name = get_source(entity).entity
    register(
        name,
        lambda f: f.raw(entity).select(*given, *[c().alias(n) for n, (c, _) in columns.items()]),
        f"SELECT {', '.join([*given, *[f'{e} AS {n}' for n, (_, e) in columns.items()]])} "
        f"FROM raw_{raw_name}",
    )


def _register_functions() -> None:
    _scalar(
        "clean_string",
        "employees",
        "emp_id",
        {
            "place": (lambda: fn.clean_string("location_code"), sql.clean("location_code")),
            "address": (lambda: fn.clean_string("email"), sql.clean("email")),
        },
    )
    _scalar(
        "normalize_email",
        "employees",
        "emp_id email",
        {"address": (lambda: fn.normalize_email("email"), sql.email("email"))},
    )
    _scalar(
        "email_domain",
        "contractors",
        "contractor_id email",
        {
            "domain": (
                lambda: fn.email_domain("email"),
                f"nullif(split_part({sql.clean('email')}, '@', 2), '')",
            )
        },
    )
    _scalar(
        "is_valid_email",
        "team_membership",
        "team_code employee_email",
        {
            "usable": (
                lambda: fn.is_valid_email("employee_email"),
                f"regexp_full_match({sql.clean('employee_email')}, "
                r"'[^@\s]+@[^@\s]+\.[A-Za-z]{2,}')",
            )
        },
    )
    _scalar(
        "parse_date",
        "team_membership",
        "start_date",
        {"day": (lambda: fn.parse_date("start_date"), sql.as_date("start_date"))},
    )
    _scalar(
        "parse_month",
        "achievements",
        "month",
        {"first_day": (lambda: fn.parse_month("month"), sql.as_month("month"))},
    )
    _scalar(
        "month_key",
        "achievements",
        "month",
        {"key": (lambda: fn.month_key("month"), f"strftime({sql.as_month('month')}, '%Y-%m')")},
    )
    _scalar(
        "parse_int",
        "team_membership",
        "allocation_pct",
        {"number": (lambda: fn.parse_int("allocation_pct"), sql.as_int("allocation_pct"))},
    )
    _scalar(
        "parse_double",
        "achievements",
        "impact_score",
        {"number": (lambda: fn.parse_double("impact_score"), sql.as_double("impact_score"))},
    )
    _scalar(
        "parse_score",
        "achievements",
        "impact_score",
        {"points": (lambda: fn.parse_score("impact_score"), sql.score("impact_score"))},
    )
    _scalar(
        "score_origin",
        "achievements",
        "impact_score",
        {"kind": (lambda: fn.score_origin("impact_score"), sql.origin("impact_score"))},
    )
    _scalar(
        "map_employment",
        "employees",
        "emp_id employment_type",
        {
            "label": (
                lambda: fn.normalize_employment_type("employment_type"),
                sql.employment("employment_type"),
            )
        },
    )
    _scalar(
        "map_engagement",
        "contractors",
        "contractor_id engagement_type",
        {
            "label": (
                lambda: fn.normalize_engagement_type("engagement_type"),
                sql.engagement("engagement_type"),
            )
        },
    )
    _scalar(
        "map_role",
        "team_membership",
        "team_code role",
        {"label": (lambda: fn.normalize_role("role"), sql.role("role"))},
    )
    _scalar(
        "map_status",
        "employees",
        "emp_id status",
        {"label": (lambda: fn.normalize_status("status"), sql.status("status"))},
    )
    _scalar(
        "map_values_custom_default",
        "team_membership",
        "team_code role",
        {
            "label": (
                lambda: fn.map_values("role", {"sme": "EXPERT", "team lead": "LEAD"}, "OTHER"),
                f"CASE lower({sql.clean('role')}) WHEN 'sme' THEN 'EXPERT' "
                "WHEN 'team lead' THEN 'LEAD' ELSE 'OTHER' END",
            )
        },
    )
    _scalar(
        "normalize_code",
        "team_membership",
        "team_code",
        {"code": (lambda: fn.normalize_code("team_code"), sql.code("team_code"))},
    )
    _scalar(
        "json_path",
        "teams",
        "team_id",
        {
            "org_id": (
                lambda: fn.json_path("organization", "$.org_id"),
                sql.clean("json_extract_string(organization, '$.org_id')"),
            ),
            "missing": (
                lambda: fn.json_path("organization", "$.nothing"),
                sql.clean("json_extract_string(organization, '$.nothing')"),
            ),
        },
    )
    _scalar(
        "upper_region",
        "locations",
        "location_code city",
        {"label": (lambda: fn.upper_label("region"), f"upper({sql.clean('region')})")},
    )
    _scalar(
        "default_label",
        "teams",
        "team_id",
        {
            "manager": (
                lambda: fn.default_label("reporting_manager_email", "UNRESOLVED"),
                "coalesce(reporting_manager_email, 'UNRESOLVED')",
            )
        },
    )
    _scalar(
        "tristate_equal",
        "teams",
        "team_id",
        {
            "led_by_manager": (
                lambda: fn.tristate_equal("team_leader_email", "reporting_manager_email"),
                "team_leader_email = reporting_manager_email",
            )
        },
    )
    parsed = sql.as_int("allocation_pct")
    _scalar(
        "cap_range",
        "team_membership",
        "team_code allocation_pct",
        {
            "capped": (
                lambda: fn.cap_range(fn.parse_int("allocation_pct"), 0, 100),
                f"CASE WHEN ({parsed}) > 100 THEN 100 WHEN ({parsed}) < 0 THEN 0 "
                f"ELSE ({parsed}) END",
            ),
            "was_capped": (lambda: fn.was_capped(fn.parse_int("allocation_pct"), 100), f"({parsed}) > 100"),
        },
    )
    _scalar(
        "active_flag",
        "team_membership",
        "team_code end_date",
        {
            "is_active": (
                lambda: fn.active_flag(fn.parse_date("end_date"), SETTINGS.as_of_column),
                f"({sql.as_date('end_date')}) IS NULL OR ({sql.as_date('end_date')}) >= {sql.AS_OF}",
            )
        },
    )
    _scalar(
        "surrogate_key",
        "achievements",
        "title category reported_by",
        {
            "sk": (
                lambda: fn.surrogate_key("team_id", "title", "category", "reported_by"),
                "sha256(coalesce(team_id, '') || '||' || coalesce(title, '') || '||' || "
                "coalesce(category, '') || '||' || coalesce(reported_by, ''))",
            )
        },
    )
    register(
        "guarded_ratio",
        lambda f: f.table("lineitem")
        .groupBy("l_partkey")
        .agg(
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.count_if(F.col("l_linestatus") == "F").alias("finished"),
        )
        .withColumn("share", fn.guarded_ratio("returned", "finished")),
        "SELECT l_partkey, returned, finished, CASE WHEN finished > 0 THEN "
        "round(returned / finished, 4) END AS share FROM (SELECT l_partkey, "
        "count(*) FILTER (l_returnflag = 'R') AS returned, "
        "count(*) FILTER (l_linestatus = 'F') AS finished FROM lineitem GROUP BY l_partkey) c",
    )
    register(
        "json_path_events",
        lambda f: f.table("events").select("event_id", fn.json_path("props", "$.k").alias("k")),
        "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    )
    register(
        "stringify_nested",
        lambda f: stringify_all(
            f.table("events").select(
                "event_id",
                "event_type",
                F.struct("user_id", "event_type").alias("who"),
                F.array("event_id", "user_id").alias("ids"),
                F.create_map("event_type", "user_id").alias("by_type"),
            )
        ),
        "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, "
        """'{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS who, """
        "'[' || event_id || ',' || user_id || ']' AS ids, "
        """'{"' || event_type || '":' || user_id || '}' AS by_type FROM events""",
    )


# Snapshots and incremental loads (A15, A21)


def _register_snapshots() -> None:
    def dated(f: Frames) -> DataFrame:
        return f.table("orders").select(
            "o_orderkey", "o_custkey", F.to_date("o_orderdate").cast("string").alias("ingest_date")
        )

    day = "strftime(o_orderdate, '%Y-%m-%d')"
    newest = f"(SELECT max({day}) FROM orders)"
    register(
        "latest_snapshot",
        lambda f: latest_snapshot(dated(f)),
        f"SELECT o_orderkey, o_custkey FROM orders WHERE {day} = {newest}",
    )
    register(
        "requested_snapshot",
        lambda f: latest_snapshot(dated(f), "1996-03-05"),
        f"SELECT o_orderkey, o_custkey FROM orders WHERE {day} = CASE WHEN EXISTS (SELECT 1 FROM "
        f"orders WHERE {day} = '1996-03-05') THEN '1996-03-05' ELSE {newest} END",
    )
    register(
        "missing_snapshot",
        lambda f: latest_snapshot(dated(f), "2050-01-01"),
        f"SELECT o_orderkey, o_custkey FROM orders WHERE {day} = {newest}",
    )
    register(
        "incremental_load",
        lambda f: incremental(f.raw("employees"), "hire_date", F.lit(date(2018, 6, 30)), fn.parse_date),
        f"SELECT * FROM raw_employees WHERE {sql.as_date('hire_date')} > DATE '2018-06-30'",
    )
    register(
        "next_watermark",
        lambda f: next_watermark(f.raw("employees"), "hire_date", fn.parse_date),
        f"SELECT max({sql.as_date('hire_date')}) AS next_watermark FROM raw_employees",
    )


# Validation, dedup and conformed entities (C, D1, E)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _labelled(df: DataFrame, entity: str) -> DataFrame:
    return df.select(F.lit(entity).alias("entity"), "*")


def _rule_rows(label: str, rules: dict[str, dict[str, str]]) -> str:
    parts = [
        f"SELECT '{entity}' AS entity, '{name}' AS rule, count(*) AS {label} "
        f"FROM norm_{entity} WHERE NOT ({condition}) HAVING count(*) > 0"
        for entity, conditions in rules.items()
        for name, condition in conditions.items()
    ]
    return " UNION ALL ".join(parts)


def _register_quality() -> None:
    for entity in ENTITIES:
        register(
            f"validate_{entity}",
            lambda f, e=entity: (
                f.conformed(e)
                .outcome.annotated.withColumn("reasons", F.array_join(VIOLATIONS, "; "))
                .drop(VIOLATIONS)
            ),
            f"SELECT * FROM checked_{entity}",
        )
        register(
            f"conform_{entity}",
            lambda f, e=entity: f.silver(e),
            f"SELECT * FROM silver_{entity}",
        )
        register(
            f"rejected_{entity}",
            lambda f, e=entity: f.rejected(e).drop(VIOLATIONS),
            f"SELECT * FROM rejected_{entity}",
        )

    def counted(count: Callable) -> Callable[[Frames], DataFrame]:
        rules = contracts(SETTINGS)
        return lambda f: _union(
            [_labelled(count(f.normalized(e), rules[e]), e) for e in ENTITIES]
        )

    register("rule_failures", counted(rule_failures), _rule_rows("failures", sql.ERRORS))
    register("warning_counts", counted(warning_counts), _rule_rows("warnings", sql.WARNINGS))
    totals = ["rows_in", "rows_valid", "rows_invalid", "reject_ratio"]

    def all_totals(f: Frames) -> DataFrame:
        outcomes = {e: f.conformed(e).outcome for e in ENTITIES}
        return _union(
            [
                _labelled(outcome_totals(o.annotated, o.contract).select(*totals), e)
                for e, o in outcomes.items()
            ]
        )

    register(
        "outcome_totals",
        all_totals,
        " UNION ALL ".join(
            f"SELECT '{e}' AS entity, count(*) AS rows_in, "
            "count(*) FILTER (reasons = '') AS rows_valid, "
            "count(*) FILTER (reasons <> '') AS rows_invalid, "
            "coalesce(count(*) FILTER (reasons <> '') / count(*), 0.0) AS reject_ratio "
            f"FROM checked_{e}"
            for e in ENTITIES
        ),
    )
    register(
        "mark_rejected",
        lambda f: mark_rejected(f.raw("contractors"), "held for review"),
        "SELECT *, 'held for review' AS _rejection_reason FROM raw_contractor_roster",
    )
    keys, order = ["team_id", "employee_email"], ["start_date"]

    def per_person(f: Frames, which: int) -> DataFrame:
        return deduplicate(f.normalized("team_membership"), keys, order)[which]

    rank = (
        "SELECT *, row_number() OVER (PARTITION BY team_id, employee_email ORDER BY "
        + ", ".join(
            f"{c} NULLS LAST" for c in ("start_date", *sql.SILVER_COLUMNS["team_membership"])
        )
        + ") AS rn FROM norm_team_membership"
    )
    columns = ", ".join(sql.SILVER_COLUMNS["team_membership"])
    register(
        "dedup_kept",
        lambda f: per_person(f, 0),
        f"SELECT {columns} FROM ({rank}) r WHERE rn = 1",
    )
    register(
        "dedup_dropped",
        lambda f: per_person(f, 1),
        f"SELECT {columns}, 'duplicate_business_key[team_id,employee_email]' AS _rejection_reason "
        f"FROM ({rank}) r WHERE rn > 1",
    )
    register(
        "distinct_values",
        lambda f: f.raw("team_membership").select("role").distinct(),
        "SELECT DISTINCT role FROM raw_team_membership",
    )
    register(
        "union_by_name",
        lambda f: person_candidates(f.silver("employees"), f.silver("contractors")),
        "SELECT * FROM candidates",
    )
    register(
        "union_missing",
        lambda f: f.raw("employees").unionByName(f.raw("contractors"), allowMissingColumns=True),
        "SELECT * FROM raw_employees UNION ALL BY NAME SELECT * FROM raw_contractor_roster",
    )


# Identity and attribution (D2-D5, E5)


def _register_people() -> None:
    register("dim_person", lambda f: f.silver("dim_person"), "SELECT * FROM people")
    register(
        "person_collisions",
        lambda f: collisions_of(
            person_candidates(f.silver("employees"), f.silver("contractors"))
        ),
        "SELECT * FROM person_losers",
    )
    register(
        "dominant_location",
        lambda f: dominant_value(
            f.members,
            ["team_id"],
            "person_location_code",
            "dominant_member_location",
            "dominant_location_headcount",
        ),
        "SELECT * FROM dominant",
    )
    register(
        "achievement_facts",
        lambda f: achievement_facts(f.raw("achievements"), SETTINGS),
        "SELECT * FROM facts",
    )
    register(
        "unique_candidates",
        lambda f: unique_candidates(f.silver("team_membership"), f.silver("teams")),
        "SELECT m.employee_email, t.team_name, min(m.team_id) AS candidate_team_id "
        "FROM silver_team_membership m JOIN silver_teams t ON m.team_id = t.team_id "
        "GROUP BY 1, 2 HAVING count(DISTINCT m.team_id) = 1",
    )
    register(
        "attributed_achievements",
        lambda f: f.normalized("achievements"),
        "SELECT * FROM norm_achievements",
    )
    register(
        "attribution_summary",
        lambda f: attribution_summary(f.normalized("achievements")),
        "SELECT count(*) FILTER (team_id_origin <> 'SOURCE') AS unattributed_in_source, "
        "count(*) FILTER (team_id_origin = 'RESOLVED_VIA_REPORTER') AS resolved_via_reporter, "
        "count(*) FILTER (team_id_origin = 'UNRESOLVED') AS still_unresolved "
        "FROM norm_achievements",
    )


# Curated datasets (M1-M9)

GOLD_CHECKS = {
    "team_members": "members",
    "team_locations": "gold_locations",
    "monthly_team_achievements": "gold_achievements",
    "leader_not_colocated": "gold_colocation",
    "leader_non_direct_staff": "gold_leaders",
    "staff_ratio_analysis": "gold_ratios",
    "organization_reporting_summary": "gold_orgs",
    "employee_summary": "gold_workforce",
}


def _answers(f: Frames) -> DataFrame:
    return marts.business_answers(f.settle().gold, SETTINGS.ratio_threshold)


def _register_gold() -> None:
    for dataset, step in GOLD_CHECKS.items():
        register(dataset, lambda f, d=dataset: f.gold[d], f"SELECT * FROM {step}")
    register("business_answers", _answers, "SELECT * FROM headlines")
    register(
        "roster_resolution",
        lambda f: marts.roster_resolution(f.members),
        "SELECT count(*) FILTER (NOT person_found) AS unresolved_people, "
        "count(*) FILTER (NOT team_found) AS memberships_without_team FROM members",
    )


# Analyst queries (N1-N20)


def _register_insights() -> None:
    def over(dataset: str, query: Callable[[DataFrame], DataFrame]):
        return lambda f: query(f.gold[dataset])

    m, l, a = "team_members", "team_locations", "monthly_team_achievements"  # noqa: E741
    c, p = "leader_not_colocated", "leader_non_direct_staff"
    r, o = "staff_ratio_analysis", "organization_reporting_summary"
    register(
        "n01_roster_overview",
        over(m, insights.n01_roster_overview),
        "SELECT count(DISTINCT team_id) AS teams, count(*) AS membership_rows, "
        "count(DISTINCT employee_email) AS distinct_people, "
        "round(count(*) / count(DISTINCT team_id), 1) AS mean_team_size FROM members",
    )
    register(
        "n02_team_roster",
        over(m, insights.n02_team_roster),
        "SELECT team_id, team_name, full_name, employee_email, role, staff_type, person_city, "
        "allocation_pct, is_active FROM members "
        "WHERE team_id = (SELECT min(team_id) FROM members) "
        "ORDER BY role, full_name NULLS LAST, employee_email",
    )
    register(
        "n03_team_size_distribution",
        over(m, insights.n03_team_size_distribution),
        "SELECT team_size, count(*) AS teams FROM (SELECT count(*) AS team_size FROM members "
        "GROUP BY team_id) s GROUP BY team_size",
    )
    register(
        "n04_workforce_composition",
        over(m, insights.n04_workforce_composition),
        'SELECT staff_type, count(*) AS "people" FROM members GROUP BY staff_type',
    )
    register(
        "n05_location_overview",
        over(l, insights.n05_location_overview),
        "SELECT count(DISTINCT primary_office) AS offices, "
        "count(*) FILTER (is_distributed) AS distributed_teams, "
        "round(count(*) FILTER (is_distributed) / count(*), 4) AS distributed_share, "
        "count(*) FILTER (office_matches_members) AS office_matches FROM gold_locations",
    )
    register(
        "n06_office_breakdown",
        over(l, insights.n06_office_breakdown),
        "SELECT office_region, office_city, count(team_id) AS teams, "
        'CAST(coalesce(sum(member_count), 0) AS BIGINT) AS "members" FROM gold_locations '
        "WHERE office_region IS NOT NULL AND office_city IS NOT NULL GROUP BY 1, 2",
    )
    register(
        "n07_teams_per_place",
        over(l, insights.n07_teams_per_place),
        "SELECT 'city' AS kind, office_city AS place, count(*) AS teams FROM gold_locations "
        "WHERE office_city IS NOT NULL GROUP BY 2 UNION ALL "
        "SELECT 'region', office_region, count(*) FROM gold_locations "
        "WHERE office_region IS NOT NULL GROUP BY 2",
    )
    register(
        "n08_achievement_overview",
        over(a, insights.n08_achievement_overview),
        "SELECT count(DISTINCT month_key) AS months, min(month_key) AS first_month, "
        "max(month_key) AS last_month, count(*) AS team_months, "
        "CAST(coalesce(sum(achievement_count), 0) AS BIGINT) AS achievements, "
        "round(round(avg(avg_impact_score_numeric), 9), 2) AS mean_impact_numeric "
        "FROM gold_achievements",
    )
    register(
        "n09_monthly_rollup",
        over(a, insights.n09_monthly_rollup),
        "SELECT month_key, CAST(sum(achievement_count) AS BIGINT) AS achievements, "
        "count(DISTINCT team_id) AS teams_reporting, "
        "round(round(avg(avg_impact_score_numeric), 9), 2) AS avg_impact "
        "FROM gold_achievements GROUP BY month_key",
    )
    register(
        "n10_top_teams_by_impact",
        over(a, insights.n10_top_teams_by_impact),
        "SELECT team_id, team_name, CAST(sum(achievement_count) AS BIGINT) AS achievements, "
        "round(coalesce(sum(total_impact_score), 0.0), 2) AS total_impact FROM gold_achievements "
        "WHERE team_name IS NOT NULL GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 10",
    )
    register(
        "n11_colocation_overview",
        over(c, insights.n11_colocation_overview),
        "SELECT count(*) AS teams, count(*) FILTER (leader_not_colocated) AS not_colocated, "
        "round(count(*) FILTER (leader_not_colocated) / count(*), 4) AS not_colocated_share, "
        "count(*) FILTER (NOT is_colocated_with_office) AS not_at_office, "
        "count(*) FILTER (is_colocated_with_members IS NULL) AS undetermined, "
        "count(*) FILTER (is_colocated_with_members) AS colocated FROM gold_colocation",
    )
    register(
        "n12_leaders_by_staff_type",
        over(p, insights.n12_leaders_by_staff_type),
        "SELECT leader_staff_type, count(*) AS teams FROM gold_leaders GROUP BY 1",
    )
    register(
        "n13_leader_agencies",
        over(p, insights.n13_leader_agencies),
        "SELECT leader_agency AS agency, count(*) AS teams_led FROM gold_leaders "
        "WHERE leader_is_non_direct AND leader_agency IS NOT NULL GROUP BY 1",
    )
    register(
        "n14_ratio_overview",
        over(r, insights.n14_ratio_overview),
        "SELECT count(*) AS teams, count(*) FILTER (exceeds_threshold) AS above_threshold, "
        "round(count(*) FILTER (exceeds_threshold) / count(*), 4) AS above_share, "
        "round(round(avg(non_direct_ratio), 9), 4) AS mean_ratio, "
        "round(quantile_cont(non_direct_ratio, 0.5), 5) AS median_ratio, "
        "max(non_direct_ratio) AS max_ratio FROM gold_ratios",
    )
    register(
        "n15_top_teams_by_ratio",
        over(r, insights.n15_top_teams_by_ratio),
        "SELECT team_id, team_name, member_count, direct_count, non_direct_count, "
        "non_direct_ratio FROM gold_ratios WHERE non_direct_ratio IS NOT NULL "
        "ORDER BY non_direct_ratio DESC, team_id, team_name NULLS LAST LIMIT 10",
    )
    register(
        "n16_ratio_histogram",
        over(r, insights.n16_ratio_histogram),
        "SELECT CAST(least(floor((g.non_direct_ratio - b.lo) * 30.0 / (b.hi - b.lo)) + 1, 30) AS "
        "INTEGER) AS bin, count(*) AS teams, count(*) FILTER (exceeds_threshold) AS above, "
        "count(*) FILTER (NOT exceeds_threshold) AS not_above FROM gold_ratios g, "
        "(SELECT min(non_direct_ratio) AS lo, max(non_direct_ratio) AS hi FROM gold_ratios) b "
        "WHERE g.non_direct_ratio IS NOT NULL GROUP BY 1",
    )
    register(
        "n16_threshold_split",
        over(r, insights.n16_threshold_split),
        "SELECT coalesce(exceeds_threshold, false) AS above_threshold, count(*) AS teams "
        "FROM gold_ratios GROUP BY 1",
    )
    register(
        "n17_reporting_claims",
        over(o, insights.n17_reporting_claims),
        "SELECT CAST(coalesce(sum(teams_claiming_org_leader), 0) AS BIGINT) AS claimed, "
        "CAST(coalesce(sum(teams_verified_org_leader), 0) AS BIGINT) AS verified, "
        "CAST(coalesce(sum(teams_claim_unverified), 0) AS BIGINT) AS unverified, "
        "CAST(coalesce(sum(teams_claiming_org_leader), 0) - "
        "coalesce(sum(teams_verified_org_leader), 0) AS BIGINT) AS overstated_by FROM gold_orgs",
    )
    widths = {
        "team_members": 23,
        "team_locations": 17,
        "monthly_team_achievements": 14,
        "leader_not_colocated": 13,
        "leader_non_direct_staff": 11,
        "staff_ratio_analysis": 14,
        "organization_reporting_summary": 9,
        "employee_summary": 8,
    }
    register(
        "n18_dataset_inventory",
        lambda f: insights.n18_dataset_inventory({d: f.settle().gold[d] for d in GOLD_CHECKS}),
        " UNION ALL ".join(
            f"SELECT '{d}' AS dataset, (SELECT count(*) FROM {GOLD_CHECKS[d]}) AS rows, "
            f"{width} AS columns"
            for d, width in widths.items()
        ),
    )
    register(
        "n19_attribution_recovery",
        over(a, insights.n19_attribution_recovery),
        "SELECT CAST(coalesce(sum(achievement_count), 0) AS BIGINT) AS achievements, "
        "CAST(coalesce(sum(attributed_via_reporter), 0) AS BIGINT) AS attributed_via_reporter "
        "FROM gold_achievements",
    )
    register(
        "n20_answer_consistency",
        lambda f: insights.n20_answer_consistency(_answers(f), f.gold),
        "SELECT question_id, answer AS recomputed, answer AS stored, true AS matches "
        "FROM headlines WHERE question_id IN ('Q1', 'Q4', 'Q5', 'Q6', 'Q7')",
    )


# Gates over run metrics (K2-K5)


def _register_gates() -> None:
    limits = " ".join(f"WHEN '{name}' THEN {limit}" for name, limit in EXCEPTIONS.items())
    agrees = "rows_read = 0 OR rows_written + rows_quarantined = rows_read"
    register(
        "reconcile",
        lambda f: gates.reconcile(f.run_metrics()),
        f"SELECT *, ({agrees}) AS reconciles FROM run_metrics",
    )
    register(
        "quarantine_gate",
        lambda f: gates.quarantine_gate(f.run_metrics(), EXCEPTIONS, 0.25),
        "SELECT *, round(rows_quarantined / rows_read, 6) AS quarantine_ratio FROM ("
        f"SELECT *, CAST(CASE entity {limits} ELSE 0.25 END AS DOUBLE) AS tolerance "
        "FROM run_metrics) m WHERE rows_quarantined / rows_read > tolerance",
    )
    register(
        "status_gate",
        lambda f: gates.status_gate(f.run_metrics()),
        "SELECT * FROM run_metrics WHERE status IN ('FAILED', 'SKIPPED')",
    )
    register(
        "zero_row_gate",
        lambda f: gates.zero_row_gate(f.run_metrics()),
        "SELECT * FROM run_metrics WHERE status = 'SUCCESS' AND rows_written = 0",
    )


_register_functions()
_register_snapshots()
_register_quality()
_register_people()
_register_gold()
_register_insights()
_register_gates()
timelines.register_all(register, SETTINGS)
upkeep.register_all(register, SETTINGS)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_CHECKS)
