"""Closed vocabularies for free-text categories."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeconform.functions.text import trimmed

# Source spellings (lower case) and the label each one stands for.
EMPLOYMENT_TYPES = {
    "full-time": "FULL_TIME",
    "full time": "FULL_TIME",
    "fulltime": "FULL_TIME",
    "ft": "FULL_TIME",
    "fte": "FULL_TIME",
    "employee": "FULL_TIME",
    "part-time": "PART_TIME",
    "part time": "PART_TIME",
    "pt": "PART_TIME",
}
ENGAGEMENT_TYPES = {
    "c2c": "CONTRACTOR",
    "1099": "CONTRACTOR",
    "temp": "CONTRACTOR",
    "vendor": "CONTRACTOR",
    "consultant": "CONTRACTOR",
    "contractor": "CONTRACTOR",
}
ROLES = {
    "team lead": "TEAM_LEAD",
    "team leader": "TEAM_LEAD",
    "lead": "TEAM_LEAD",
    "member": "MEMBER",
    "contributor": "MEMBER",
    "individual contributor": "MEMBER",
    "sme": "MEMBER",
}
STATUSES = {
    "active": "ACTIVE",
    "terminated": "TERMINATED",
    "ended": "ENDED",
    "inactive": "INACTIVE",
}


def map_values(value: Column | str, mapping: Mapping[str, str], default: str = "UNKNOWN") -> Column:
    """One lookup in a literal map. Null and blank are null; a spelling not listed gets ``default``."""
    key = F.lower(trimmed(value))
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.when(key != "", F.coalesce(F.try_element_at(lookup, key), F.lit(default)))


def normalize_employment_type(value: Column | str) -> Column:
    return map_values(value, EMPLOYMENT_TYPES)


def normalize_engagement_type(value: Column | str) -> Column:
    return map_values(value, ENGAGEMENT_TYPES)


def normalize_role(value: Column | str) -> Column:
    return map_values(value, ROLES)


def normalize_status(value: Column | str) -> Column:
    return map_values(value, STATUSES)
