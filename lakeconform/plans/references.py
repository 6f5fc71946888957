"""Which entity refers to which. Not part of the contracts that a run applies by itself."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.operators.quality import Contract, Reference, validate, with_reason
from lakeconform.operators.references import check_references, reference_failures
from lakeconform.plans.contracts import get_contract
from lakeconform.settings import Settings

REFERENCES: dict[str, tuple[Reference, ...]] = {
    "employees": (
        Reference("place_known", "location_code", "locations", "location_code"),
        Reference("manager_known", "manager_emp_id", "employees", "emp_id"),
    ),
    "contractors": (Reference("place_known", "location_code", "locations", "location_code"),),
    "organizations": (Reference("leader_known", "org_leader_email", "dim_person", "email"),),
    "teams": (
        Reference("organization_known", "org_id", "organizations", "org_id"),
        Reference("leader_known", "team_leader_email", "dim_person", "email"),
        Reference("manager_known", "reporting_manager_email", "dim_person", "email"),
    ),
    "team_membership": (
        Reference("team_known", "team_id", "teams", "team_id"),
        Reference("member_known", "employee_email", "dim_person", "email"),
    ),
}


def referential_contract(entity: str, settings: Settings) -> Contract:
    """The entity's contract with its references."""
    return replace(get_contract(entity, settings), references=REFERENCES[entity])


def all_failures(silver: Callable[[str], DataFrame], settings: Settings) -> DataFrame:
    """Failed references of every entity: ``entity``, ``rule``, ``failures``, ``keys``."""
    found = []
    for entity, references in REFERENCES.items():
        parents = {r.parent: silver(r.parent) for r in references}
        failures = reference_failures(silver(entity), referential_contract(entity, settings), parents)
        found.append(failures.select(F.lit(entity).alias("entity"), "rule", "failures", "keys"))
    return reduce(DataFrame.unionByName, found)


def adrift(entity: str, silver: Callable[[str], DataFrame], settings: Settings) -> DataFrame:
    """The conformed rows of an entity that refer to nothing known, with the reason, for quarantine."""
    contract = referential_contract(entity, settings)
    annotated = validate(silver(entity), contract).annotated
    parents = {r.parent: silver(r.parent) for r in contract.references}
    return with_reason(check_references(annotated, contract, parents))
