"""From raw text to conformed entities: one select per entity, then contract and dedup."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.functions import (
    active_flag,
    cap_range,
    clean_string,
    json_path,
    month_key,
    normalize_code,
    normalize_email,
    normalize_employment_type,
    normalize_engagement_type,
    normalize_role,
    normalize_status,
    parse_date,
    parse_int,
    parse_score,
    score_origin,
    surrogate_key,
    upper_label,
    was_capped,
)
from lakeconform.operators.attribution import attribute_unique
from lakeconform.operators.dedup import duplicates, keep_first
from lakeconform.operators.quality import (
    Outcome,
    SchemaDriftError,
    outcome_totals,
    validate,
)
from lakeconform.plans.contracts import get_contract
from lakeconform.settings import Settings

# Which column decides between rows that share a business key; the rest of the row breaks ties.
DEDUP_ORDER: dict[str, tuple[str, ...]] = {
    "locations": ("city",),
    "organizations": ("org_id",),
    "employees": ("status", "hire_date"),
    "contractors": ("status", "start_date"),
    "teams": ("formed_date",),
    # MEMBER sorts before TEAM_LEAD, so it wins a collision.
    "team_membership": ("role", "allocation_pct"),
    "achievements": ("month_key",),
}


@dataclass(frozen=True)
class Conformed:
    """Lazy result of one entity: kept and rejected rows add up to the input."""

    outcome: Outcome

    @property
    def _key(self) -> tuple[tuple[str, ...], tuple[str, ...]]:
        contract = self.outcome.contract
        return contract.key, DEDUP_ORDER[contract.entity]

    @cached_property
    def kept(self) -> DataFrame:
        return keep_first(self.outcome.df, *self._key, where=self.outcome.passes)

    @cached_property
    def dropped(self) -> DataFrame:
        return duplicates(self.outcome.valid, *self._key)

    @cached_property
    def rejected(self) -> DataFrame:
        return self.outcome.invalid.unionByName(self.dropped, allowMissingColumns=True)

    @cached_property
    def metrics(self) -> DataFrame:
        return outcome_totals(self.outcome.annotated, self.outcome.contract)


def _carried(raw: DataFrame) -> list[Column]:
    """Lineage columns ride along."""
    return [F.col(name) for name in raw.columns if name.startswith("_")]


def _email(name: str, settings: Settings) -> Column:
    return normalize_email(name, settings.canonical_domain, settings.domain_typos)


def normalize_locations(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        clean_string("location_code").alias("location_code"),
        clean_string("city").alias("city"),
        clean_string("country").alias("country"),
        upper_label("region").alias("region"),
        clean_string("timezone").alias("timezone"),
        *_carried(raw),
    )


def normalize_organizations(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        clean_string("org_id").alias("org_id"),
        clean_string("org_name").alias("org_name"),
        _email("org_leader_email", settings).alias("org_leader_email"),
        *_carried(raw),
    )


def normalize_employees(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        clean_string("emp_id").alias("emp_id"),
        clean_string("full_name").alias("full_name"),
        _email("email", settings).alias("email"),
        clean_string("department").alias("department"),
        clean_string("location_code").alias("location_code"),
        normalize_employment_type("employment_type").alias("employment_type"),
        clean_string("manager_emp_id").alias("manager_emp_id"),
        parse_date("hire_date", settings.date_formats).alias("hire_date"),
        normalize_status("status").alias("status"),
        *_carried(raw),
    )


def normalize_contractors(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        clean_string("contractor_id").alias("contractor_id"),
        clean_string("full_name").alias("full_name"),
        _email("email", settings).alias("email"),
        clean_string("agency").alias("agency"),
        clean_string("location_code").alias("location_code"),
        normalize_engagement_type("engagement_type").alias("engagement_type"),
        parse_date("start_date", settings.date_formats).alias("start_date"),
        parse_date("end_date", settings.date_formats).alias("end_date"),
        normalize_status("status").alias("status"),
        *_carried(raw),
    )


def normalize_teams(raw: DataFrame, settings: Settings) -> DataFrame:
    return raw.select(
        normalize_code("team_id").alias("team_id"),
        clean_string("team_name").alias("team_name"),
        json_path("organization", "$.org_id").alias("org_id"),
        json_path("organization", "$.org_name").alias("org_name"),
        _email("team_leader_email", settings).alias("team_leader_email"),
        clean_string("primary_office").alias("primary_office"),
        clean_string("reports_to_type").alias("reports_to_type"),
        _email("reporting_manager_email", settings).alias("reporting_manager_email"),
        parse_date("formed_date", settings.date_formats).alias("formed_date"),
        *_carried(raw),
    )


def normalize_team_membership(raw: DataFrame, settings: Settings) -> DataFrame:
    """The allocation is capped to 0..100 and flagged; the given number is kept beside it."""
    typed = raw.select(
        normalize_code("team_code").alias("team_id"),
        _email("employee_email", settings).alias("employee_email"),
        normalize_role("role").alias("role"),
        parse_int("allocation_pct").alias("allocation_pct_raw"),
        parse_date("start_date", settings.date_formats).alias("start_date"),
        parse_date("end_date", settings.date_formats).alias("end_date"),
        *_carried(raw),
    )
    return typed.select(
        "team_id",
        "employee_email",
        "role",
        "allocation_pct_raw",
        cap_range("allocation_pct_raw", 0, 100).alias("allocation_pct"),
        was_capped("allocation_pct_raw", 100).alias("allocation_was_capped"),
        "start_date",
        "end_date",
        active_flag("end_date", settings.as_of_column).alias("is_active"),
        *_carried(raw),
    )


def achievement_facts(raw: DataFrame, settings: Settings) -> DataFrame:
    """Typed achievements before attribution. A feed may lack ``team_id`` altogether."""
    source_team = (
        normalize_code("team_id") if "team_id" in raw.columns else F.lit(None).cast("string")
    )
    typed = raw.select(
        source_team.alias("source_team_id"),
        clean_string("team_name").alias("team_name"),
        month_key("month", settings.month_formats).alias("month_key"),
        clean_string("title").alias("title"),
        clean_string("category").alias("category"),
        parse_score("impact_score", settings.score_bands).alias("impact_score"),
        score_origin("impact_score", settings.score_bands).alias("impact_source_type"),
        _email("reported_by", settings).alias("reported_by"),
        *_carried(raw),
    )
    # The feed has no key of its own; these six columns stand for one.
    key = surrogate_key(
        "month_key", "title", "category", "reported_by", "team_name", "source_team_id"
    )
    return typed.withColumn("achievement_sk", key)


def normalize_achievements(
    raw: DataFrame, memberships: DataFrame, teams: DataFrame, settings: Settings
) -> DataFrame:
    facts = achievement_facts(raw, settings)
    return attribute_unique(facts, memberships, teams).drop("source_team_id")


# The raw columns that each normaliser reads. A feed of achievements may lack ``team_id``.
RAW_COLUMNS = {
    "locations": ("location_code", "city", "country", "region", "timezone"),
    "organizations": ("org_id", "org_name", "org_leader_email"),
    "employees": (
        "emp_id", "full_name", "email", "department", "location_code", "employment_type",
        "manager_emp_id", "hire_date", "status",
    ),
    "contractors": (
        "contractor_id", "full_name", "email", "agency", "location_code", "engagement_type",
        "start_date", "end_date", "status",
    ),
    "teams": (
        "team_id", "team_name", "organization", "team_leader_email", "primary_office",
        "reports_to_type", "reporting_manager_email", "formed_date",
    ),
    "team_membership": (
        "team_code", "employee_email", "role", "allocation_pct", "start_date", "end_date",
    ),
    "achievements": ("team_name", "month", "title", "category", "impact_score", "reported_by"),
}


def check_raw(raw: DataFrame, entity: str) -> None:
    """Raise if a feed has lost a column. To be asked before normalising, whose result always
    has every column."""
    missing = [name for name in RAW_COLUMNS[entity] if name not in raw.columns]
    if missing:
        raise SchemaDriftError(
            f"{entity}: missing raw columns {missing}; present {sorted(raw.columns)}"
        )


NORMALIZERS = {
    "locations": normalize_locations,
    "organizations": normalize_organizations,
    "employees": normalize_employees,
    "contractors": normalize_contractors,
    "teams": normalize_teams,
    "team_membership": normalize_team_membership,
}


def conform(entity: str, normalized: DataFrame, settings: Settings) -> Conformed:
    """The tail every entity shares: contract, then one row per business key."""
    return Conformed(validate(normalized, get_contract(entity, settings)))


def conform_locations(raw: DataFrame, settings: Settings) -> Conformed:
    return conform("locations", normalize_locations(raw, settings), settings)


def conform_organizations(raw: DataFrame, settings: Settings) -> Conformed:
    return conform("organizations", normalize_organizations(raw, settings), settings)


def conform_employees(raw: DataFrame, settings: Settings) -> Conformed:
    return conform("employees", normalize_employees(raw, settings), settings)


def conform_contractors(raw: DataFrame, settings: Settings) -> Conformed:
    return conform("contractors", normalize_contractors(raw, settings), settings)


def conform_teams(raw: DataFrame, settings: Settings) -> Conformed:
    return conform("teams", normalize_teams(raw, settings), settings)


def conform_team_membership(raw: DataFrame, settings: Settings) -> Conformed:
    return conform("team_membership", normalize_team_membership(raw, settings), settings)


def conform_achievements(
    raw: DataFrame, memberships: DataFrame, teams: DataFrame, settings: Settings
) -> Conformed:
    normalized = normalize_achievements(raw, memberships, teams, settings)
    return conform("achievements", normalized, settings)
