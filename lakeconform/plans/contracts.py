"""The contracts of the seven conformed entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeconform.operators.quality import WARNING, Contract, Rule
from lakeconform.settings import Settings

EMAIL = "RLIKE '^[^@ ]+@[^@ ]+[.][A-Za-z]{2,}$'"


def _present(name: str, column: str, why: str) -> Rule:
    return Rule(name, f"{column} IS NOT NULL", why, null_passes=False)


def _warn(name: str, expr: str, why: str) -> Rule:
    return Rule(name, expr, why, WARNING)


# Fixed values below: rule names appear in rejection reasons and, with columns, keys,
# conditions, severities and tolerances, decide which rows pass.
_ORDERED = "end_date IS NULL OR start_date IS NULL OR end_date >= start_date"


def contracts(settings: Settings | None = None) -> dict[str, Contract]:
    """Every contract by entity name. "Not in the future" compares with ``settings.as_of``."""
    today = (settings or Settings()).as_of_sql
    declared = (
        Contract(
            "employees",
            ("emp_id", "email", "location_code", "employment_type", "status"),
            ("emp_id",),
            (
                _present("emp_id_required", "emp_id", "a person needs an id"),
                Rule("emp_id_format", "emp_id RLIKE '^EMP-[0-9]+$'", "id is EMP- and digits"),
                _present("email_required", "email", "rosters find people by address"),
                Rule("email_format", f"email {EMAIL}", "address is usable after repair"),
                Rule("status_known", "status IN ('ACTIVE','TERMINATED')", "two statuses exist"),
                Rule(
                    "employment_type_known",
                    "employment_type <> 'UNKNOWN'",
                    "spelling is in the vocabulary",
                ),
                _warn("hire_date_parsed", "hire_date IS NOT NULL", "date has a known format"),
                Rule("hire_date_not_future", f"hire_date <= {today}", "hired by now"),
                _warn("location_present", "location_code IS NOT NULL", "person can be placed"),
            ),
        ),
        Contract(
            "contractors",
            ("contractor_id", "email", "engagement_type", "status"),
            ("contractor_id",),
            (
                _present("contractor_id_required", "contractor_id", "an engagement needs an id"),
                Rule(
                    "contractor_id_format",
                    "contractor_id RLIKE '^CTR-[0-9]+$'",
                    "id is CTR- and digits",
                ),
                _present("email_required", "email", "rosters find people by address"),
                Rule("email_format", f"email {EMAIL}", "address is usable after repair"),
                Rule(
                    "engagement_type_known",
                    "engagement_type = 'CONTRACTOR'",
                    "spelling is in the vocabulary",
                ),
                Rule(
                    "status_known",
                    "status IN ('ACTIVE','ENDED','TERMINATED','INACTIVE')",
                    "four statuses exist",
                ),
                _warn("engagement_dates_ordered", _ORDERED, "odd dates leave the person usable"),
                _warn("location_present", "location_code IS NOT NULL", "person can be placed"),
            ),
        ),
        Contract(
            "locations",
            ("location_code", "city", "country", "region", "timezone"),
            ("location_code",),
            (
                _present("location_code_required", "location_code", "an office needs a code"),
                Rule(
                    "location_code_format",
                    "location_code RLIKE '^LOC-[0-9]+$'",
                    "code is LOC- and digits",
                ),
                Rule("region_known", "region IN ('AMER','EMEA','APAC')", "three regions exist"),
                _present("city_required", "city", "reports name the city"),
                _warn("timezone_required", "timezone IS NOT NULL", "time zone is wanted"),
            ),
        ),
        Contract(
            "organizations",
            ("org_id", "org_name", "org_leader_email"),
            ("org_id",),
            (
                _present("org_id_required", "org_id", "an organization needs an id"),
                Rule("org_id_format", "org_id RLIKE '^ORG-[0-9]+$'", "id is ORG- and digits"),
                _present("org_name_required", "org_name", "reports name the organization"),
                Rule(
                    "leader_email_format",
                    f"org_leader_email {EMAIL}",
                    "reporting lines are checked against the address",
                ),
            ),
        ),
        Contract(
            "teams",
            ("team_id", "team_name", "team_leader_email", "primary_office", "reports_to_type"),
            ("team_id",),
            (
                _present("team_id_required", "team_id", "a team needs an id"),
                Rule("team_id_format", "team_id RLIKE '^TM-[0-9]+$'", "id is TM- and digits"),
                _present("team_name_required", "team_name", "reports name the team"),
                Rule(
                    "leader_email_format",
                    f"team_leader_email {EMAIL}",
                    "leaders are found by address",
                ),
                _present("primary_office_required", "primary_office", "a team has an office"),
                _warn("org_id_present", "org_id IS NOT NULL", "team belongs somewhere"),
                _warn("formed_date_parsed", "formed_date IS NOT NULL", "date has a known format"),
                Rule("formed_date_not_future", f"formed_date <= {today}", "formed by now"),
            ),
        ),
        Contract(
            "team_membership",
            ("team_id", "employee_email", "role", "allocation_pct"),
            ("team_id", "employee_email", "start_date"),
            (
                _present("team_id_required", "team_id", "a membership names its team"),
                Rule("team_id_format", "team_id RLIKE '^TM-[0-9]+$'", "id is TM- and digits"),
                _present("email_required", "employee_email", "a membership names a person"),
                Rule("email_format", f"employee_email {EMAIL}", "address is usable after repair"),
                Rule("role_known", "role IN ('TEAM_LEAD','MEMBER')", "two roles exist"),
                _warn(
                    "allocation_in_range",
                    "allocation_pct_raw BETWEEN 0 AND 100",
                    "an odd share is capped; the person stays on the team",
                ),
                _warn("allocation_present", "allocation_pct IS NOT NULL", "share is a number"),
                _warn("membership_dates_ordered", _ORDERED, "odd dates leave the row usable"),
                _warn("start_date_parsed", "start_date IS NOT NULL", "date has a known format"),
            ),
        ),
        Contract(
            "achievements",
            ("achievement_sk", "month_key", "team_id", "title", "category"),
            ("achievement_sk",),
            (
                _present("surrogate_key_required", "achievement_sk", "rows are told apart by it"),
                _present("team_id_resolved", "team_id", "an achievement belongs to a team"),
                Rule("team_id_format", "team_id RLIKE '^TM-[0-9]+$'", "id is TM- and digits"),
                Rule(
                    "month_parsed",
                    "month_key RLIKE '^[0-9]{4}-[0-9]{2}$'",
                    "rollups are monthly",
                    null_passes=False,
                ),
                _present("title_required", "title", "an achievement says what it is"),
                _warn("category_required", "category IS NOT NULL", "category is wanted"),
                Rule("impact_score_in_range", "impact_score BETWEEN 0 AND 10", "0 to 10 scale"),
                _warn("impact_score_present", "impact_score IS NOT NULL", "score is wanted"),
                _warn("reporter_email_format", f"reported_by {EMAIL}", "reporter can be found"),
            ),
            tolerance=0.40,
        ),
    )
    return {contract.entity: contract for contract in declared}


def get_contract(name: str, settings: Settings | None = None) -> Contract:
    known = contracts(settings)
    if name not in known:
        raise KeyError(f"no contract for {name!r}; known: {sorted(known)}")
    return known[name]


def rule_catalogue(spark: SparkSession, settings: Settings | None = None) -> DataFrame:
    """Every declared rule as a row, for documentation."""
    rows = [
        (contract.entity, rule.name, rule.severity, rule.expr, rule.description)
        for contract in contracts(settings).values()
        for rule in contract.rules
    ]
    return spark.createDataFrame(
        rows, "entity string, rule string, severity string, expression string, description string"
    )
