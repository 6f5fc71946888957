"""DuckDB SQL that recomputes every registered query from the same tables, independently.

Each named step is a CTE; a query pulls in the steps it mentions.
"""

from __future__ import annotations

import re

from lakeconform.catalog.projection import raw_sql

AS_OF = "DATE '2024-02-01'"
THRESHOLD = "0.2"


def clean(x: str) -> str:
    return f"nullif(trim(CAST({x} AS VARCHAR)), '')"


def email(x: str) -> str:
    text = f"lower({clean(x)})"
    host = f"split_part({text}, '@', 2)"
    return (
        f"CASE WHEN contains({text}, '@') THEN split_part({text}, '@', 1) || '@' || "
        f"CASE WHEN {host} IN ('acmeinc.com', 'acme_inc.com', 'acme-inc.co') "
        f"THEN 'acme-inc.com' ELSE {host} END END"
    )


def as_date(x: str) -> str:
    formats = "['%Y-%m-%d', '%Y/%m/%d', '%m/%d/%Y', '%d-%b-%Y', '%B %d, %Y', '%d %B %Y']"
    return f"CAST(try_strptime({clean(x)}, {formats}) AS DATE)"


def as_month(x: str) -> str:
    return f"CAST(try_strptime({clean(x)}, ['%Y-%m', '%Y/%m', '%B %Y']) AS DATE)"


def as_int(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({clean(x)}, '-?[0-9]+') "
        f"THEN TRY_CAST({clean(x)} AS INTEGER) END"
    )


def as_double(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({clean(x)}, '-?[0-9]+([.][0-9]+)?') "
        f"THEN TRY_CAST({clean(x)} AS DOUBLE) END"
    )


def score(x: str) -> str:
    bands = "WHEN 'low' THEN 2.5 WHEN 'medium' THEN 5.0 WHEN 'high' THEN 8.0"
    return f"coalesce({as_double(x)}, CAST(CASE lower({clean(x)}) {bands} END AS DOUBLE))"


def origin(x: str) -> str:
    return (
        f"CASE WHEN ({as_double(x)}) IS NOT NULL THEN 'NUMERIC' "
        f"WHEN lower({clean(x)}) IN ('low', 'medium', 'high') THEN 'BAND' "
        f"WHEN {clean(x)} IS NULL THEN 'MISSING' ELSE 'UNPARSEABLE' END"
    )


def code(x: str) -> str:
    digits = f"regexp_extract(upper({clean(x)}), '^TM-?0*([0-9]+)$', 1)"
    return (
        f"CASE WHEN {digits} <> '' THEN 'TM-' || CASE WHEN length({digits}) < 3 "
        f"THEN lpad({digits}, 3, '0') ELSE {digits} END END"
    )


def _vocabulary(x: str, labels: dict[str, str]) -> str:
    cases = " ".join(
        f"WHEN lower({clean(x)}) IN ({spellings}) THEN '{label}'"
        for label, spellings in labels.items()
    )
    return f"CASE WHEN {clean(x)} IS NULL THEN NULL {cases} ELSE 'UNKNOWN' END"


def employment(x: str) -> str:
    return _vocabulary(
        x,
        {
            "FULL_TIME": "'full-time', 'full time', 'fulltime', 'ft', 'fte', 'employee'",
            "PART_TIME": "'part-time', 'part time', 'pt'",
        },
    )


def engagement(x: str) -> str:
    spellings = "'c2c', '1099', 'temp', 'vendor', 'consultant', 'contractor'"
    return _vocabulary(x, {"CONTRACTOR": spellings})


def role(x: str) -> str:
    return _vocabulary(
        x,
        {
            "TEAM_LEAD": "'team lead', 'team leader', 'lead'",
            "MEMBER": "'member', 'contributor', 'individual contributor', 'sme'",
        },
    )


def status(x: str) -> str:
    known = ("active", "terminated", "ended", "inactive")
    return _vocabulary(x, {name.upper(): f"'{name}'" for name in known})


def _is_email(x: str) -> str:
    return f"regexp_full_match({x}, '[^@ ]+@[^@ ]+[.][A-Za-z]{{2,}}')"


def _is_code(x: str, prefix: str) -> str:
    return f"regexp_full_match({x}, '{prefix}-[0-9]+')"


_ORDERED = "end_date IS NULL OR start_date IS NULL OR end_date >= start_date"

# Per entity: rejecting rules and warnings, as conditions that are never unknown.
ERRORS = {
    "locations": {
        "location_code_required": "location_code IS NOT NULL",
        "location_code_format": f"coalesce({_is_code('location_code', 'LOC')}, true)",
        "region_known": "coalesce(region IN ('AMER', 'EMEA', 'APAC'), true)",
        "city_required": "city IS NOT NULL",
    },
    "organizations": {
        "org_id_required": "org_id IS NOT NULL",
        "org_id_format": f"coalesce({_is_code('org_id', 'ORG')}, true)",
        "org_name_required": "org_name IS NOT NULL",
        "leader_email_format": f"coalesce({_is_email('org_leader_email')}, true)",
    },
    "employees": {
        "emp_id_required": "emp_id IS NOT NULL",
        "emp_id_format": f"coalesce({_is_code('emp_id', 'EMP')}, true)",
        "email_required": "email IS NOT NULL",
        "email_format": f"coalesce({_is_email('email')}, true)",
        "status_known": "coalesce(status IN ('ACTIVE', 'TERMINATED'), true)",
        "employment_type_known": "coalesce(employment_type <> 'UNKNOWN', true)",
        "hire_date_not_future": f"coalesce(hire_date <= {AS_OF}, true)",
    },
    "contractors": {
        "contractor_id_required": "contractor_id IS NOT NULL",
        "contractor_id_format": f"coalesce({_is_code('contractor_id', 'CTR')}, true)",
        "email_required": "email IS NOT NULL",
        "email_format": f"coalesce({_is_email('email')}, true)",
        "engagement_type_known": "coalesce(engagement_type = 'CONTRACTOR', true)",
        "status_known": "coalesce(status IN ('ACTIVE', 'ENDED', 'TERMINATED', 'INACTIVE'), true)",
    },
    "teams": {
        "team_id_required": "team_id IS NOT NULL",
        "team_id_format": f"coalesce({_is_code('team_id', 'TM')}, true)",
        "team_name_required": "team_name IS NOT NULL",
        "leader_email_format": f"coalesce({_is_email('team_leader_email')}, true)",
        "primary_office_required": "primary_office IS NOT NULL",
        "formed_date_not_future": f"coalesce(formed_date <= {AS_OF}, true)",
    },
    "team_membership": {
        "team_id_required": "team_id IS NOT NULL",
        "team_id_format": f"coalesce({_is_code('team_id', 'TM')}, true)",
        "email_required": "employee_email IS NOT NULL",
        "email_format": f"coalesce({_is_email('employee_email')}, true)",
        "role_known": "coalesce(role IN ('TEAM_LEAD', 'MEMBER'), true)",
    },
    "achievements": {
        "surrogate_key_required": "achievement_sk IS NOT NULL",
        "team_id_resolved": "team_id IS NOT NULL",
        "team_id_format": f"coalesce({_is_code('team_id', 'TM')}, true)",
        "month_parsed": "month_key IS NOT NULL",
        "title_required": "title IS NOT NULL",
        "impact_score_in_range": "coalesce(impact_score BETWEEN 0 AND 10, true)",
    },
}
WARNINGS = {
    "locations": {"timezone_required": "timezone IS NOT NULL"},
    "organizations": {},
    "employees": {
        "hire_date_parsed": "hire_date IS NOT NULL",
        "location_present": "location_code IS NOT NULL",
    },
    "contractors": {
        "engagement_dates_ordered": _ORDERED,
        "location_present": "location_code IS NOT NULL",
    },
    "teams": {
        "org_id_present": "org_id IS NOT NULL",
        "formed_date_parsed": "formed_date IS NOT NULL",
    },
    "team_membership": {
        "allocation_in_range": "coalesce(allocation_pct_raw BETWEEN 0 AND 100, true)",
        "allocation_present": "allocation_pct IS NOT NULL",
        "membership_dates_ordered": _ORDERED,
        "start_date_parsed": "start_date IS NOT NULL",
    },
    "achievements": {
        "category_required": "category IS NOT NULL",
        "impact_score_present": "impact_score IS NOT NULL",
        "reporter_email_format": f"coalesce({_is_email('reported_by')}, true)",
    },
}
KEYS = {
    "locations": ("location_code",),
    "organizations": ("org_id",),
    "employees": ("emp_id",),
    "contractors": ("contractor_id",),
    "teams": ("team_id",),
    "team_membership": ("team_id", "employee_email", "start_date"),
    "achievements": ("achievement_sk",),
}
ORDER = {
    "locations": ("city",),
    "organizations": (),
    "employees": ("status", "hire_date"),
    "contractors": ("status", "start_date"),
    "teams": ("formed_date",),
    "team_membership": ("role", "allocation_pct"),
    "achievements": ("month_key",),
}
SILVER_COLUMNS = {
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
        "team_id", "team_name", "org_id", "org_name", "team_leader_email", "primary_office",
        "reports_to_type", "reporting_manager_email", "formed_date",
    ),
    "team_membership": (
        "team_id", "employee_email", "role", "allocation_pct_raw", "allocation_pct",
        "allocation_was_capped", "start_date", "end_date", "is_active",
    ),
    "achievements": (
        "team_name", "month_key", "title", "category", "impact_score", "impact_source_type",
        "reported_by", "achievement_sk", "team_id", "team_id_origin",
    ),
}


def _select(source: str, columns: dict[str, str]) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + f" FROM {source}"


def _cleaned(*names: str) -> dict[str, str]:
    return {name: clean(name) for name in names}


def _silver_steps() -> dict[str, str]:
    steps = {
        "norm_locations": _select(
            "raw_locations",
            _cleaned("location_code", "city", "country")
            | {"region": f"upper({clean('region')})", "timezone": clean("timezone")},
        ),
        "norm_organizations": _select(
            "raw_organizations",
            _cleaned("org_id", "org_name") | {"org_leader_email": email("org_leader_email")},
        ),
        "norm_employees": _select(
            "raw_employees",
            _cleaned("emp_id", "full_name")
            | {"email": email("email")}
            | _cleaned("department", "location_code")
            | {
                "employment_type": employment("employment_type"),
                "manager_emp_id": clean("manager_emp_id"),
                "hire_date": as_date("hire_date"),
                "status": status("status"),
            },
        ),
        "norm_contractors": _select(
            "raw_contractor_roster",
            _cleaned("contractor_id", "full_name")
            | {"email": email("email")}
            | _cleaned("agency", "location_code")
            | {
                "engagement_type": engagement("engagement_type"),
                "start_date": as_date("start_date"),
                "end_date": as_date("end_date"),
                "status": status("status"),
            },
        ),
        "norm_teams": _select(
            "raw_teams",
            {
                "team_id": code("team_id"),
                "team_name": clean("team_name"),
                "org_id": clean("json_extract_string(organization, '$.org_id')"),
                "org_name": clean("json_extract_string(organization, '$.org_name')"),
                "team_leader_email": email("team_leader_email"),
                "primary_office": clean("primary_office"),
                "reports_to_type": clean("reports_to_type"),
                "reporting_manager_email": email("reporting_manager_email"),
                "formed_date": as_date("formed_date"),
            },
        ),
        "typed_membership": _select(
            "raw_team_membership",
            {
                "team_id": code("team_code"),
                "employee_email": email("employee_email"),
                "role": role("role"),
                "allocation_pct_raw": as_int("allocation_pct"),
                "start_date": as_date("start_date"),
                "end_date": as_date("end_date"),
            },
        ),
        "norm_team_membership": _select(
            "typed_membership",
            {
                "team_id": "team_id",
                "employee_email": "employee_email",
                "role": "role",
                "allocation_pct_raw": "allocation_pct_raw",
                "allocation_pct": "CASE WHEN allocation_pct_raw > 100 THEN 100 WHEN "
                "allocation_pct_raw < 0 THEN 0 ELSE allocation_pct_raw END",
                "allocation_was_capped": "allocation_pct_raw > 100",
                "start_date": "start_date",
                "end_date": "end_date",
                "is_active": f"end_date IS NULL OR end_date >= {AS_OF}",
            },
        ),
        "typed_achievements": _select(
            "raw_monthly_achievements",
            {
                "source_team_id": code("team_id"),
                "team_name": clean("team_name"),
                "month_key": f"strftime({as_month('month')}, '%Y-%m')",
                "title": clean("title"),
                "category": clean("category"),
                "impact_score": score("impact_score"),
                "impact_source_type": origin("impact_score"),
                "reported_by": email("reported_by"),
            },
        ),
        "facts": "SELECT *, sha256(concat_ws('||', "
        + ", ".join(
            f"coalesce({c}, '')"
            for c in ("month_key", "title", "category", "reported_by", "team_name", "source_team_id")
        )
        + ")) AS achievement_sk FROM typed_achievements",
        # Candidates per key the long way round: every matching membership, then a count.
        "resolved": "SELECT f.achievement_sk, min(m.team_id) AS resolved_team_id "
        "FROM (SELECT DISTINCT achievement_sk, reported_by, team_name FROM facts "
        "WHERE source_team_id IS NULL) f "
        "JOIN silver_team_membership m ON f.reported_by = m.employee_email "
        "JOIN silver_teams t ON m.team_id = t.team_id AND f.team_name = t.team_name "
        "GROUP BY f.achievement_sk HAVING count(DISTINCT m.team_id) = 1",
        "norm_achievements": "SELECT f.team_name, f.month_key, f.title, f.category, "
        "f.impact_score, f.impact_source_type, f.reported_by, f.achievement_sk, "
        "coalesce(f.source_team_id, r.resolved_team_id) AS team_id, "
        "CASE WHEN f.source_team_id IS NOT NULL THEN 'SOURCE' WHEN r.resolved_team_id IS NOT NULL "
        "THEN 'RESOLVED_VIA_REPORTER' ELSE 'UNRESOLVED' END AS team_id_origin "
        "FROM facts f LEFT JOIN resolved r ON f.achievement_sk = r.achievement_sk",
    }
    for entity in KEYS:
        failed = ", ".join(
            f"CASE WHEN NOT ({condition}) THEN '{name}' END"
            for name, condition in ERRORS[entity].items()
        )
        steps[f"checked_{entity}"] = (
            f"SELECT *, concat_ws('; ', {failed}) AS reasons FROM norm_{entity}"
        )
        order = [*ORDER[entity], *SILVER_COLUMNS[entity]]
        steps[f"ranked_{entity}"] = (
            f"SELECT *, row_number() OVER (PARTITION BY {', '.join(KEYS[entity])} ORDER BY "
            + ", ".join(f"{c} ASC NULLS LAST" for c in order)
            + f") AS rn FROM checked_{entity} WHERE reasons = ''"
        )
        columns = ", ".join(SILVER_COLUMNS[entity])
        steps[f"silver_{entity}"] = f"SELECT {columns} FROM ranked_{entity} WHERE rn = 1"
        steps[f"dropped_{entity}"] = (
            f"SELECT {columns}, 'duplicate_business_key[{','.join(KEYS[entity])}]' "
            f"AS _rejection_reason FROM ranked_{entity} WHERE rn > 1"
        )
        steps[f"rejected_{entity}"] = (
            f"SELECT {columns}, reasons AS _rejection_reason FROM checked_{entity} "
            f"WHERE reasons <> '' UNION ALL SELECT * FROM dropped_{entity}"
        )
    return steps


PERSON_COLUMNS = (
    "person_id, email, full_name, location_code, status, staff_type, person_source, "
    "department, agency"
)
_PEOPLE_STEPS = {
    "candidates": "SELECT emp_id AS person_id, email, full_name, location_code, status, "
    "'DIRECT' AS staff_type, 'employee_directory' AS person_source, department, "
    "CAST(NULL AS VARCHAR) AS agency FROM silver_employees WHERE email IS NOT NULL UNION ALL "
    "SELECT contractor_id, email, full_name, location_code, status, 'NON_DIRECT', "
    "'vendor_management', NULL, agency FROM silver_contractors WHERE email IS NOT NULL",
    "ranked_people": "SELECT *, row_number() OVER (PARTITION BY email ORDER BY staff_type, "
    "CASE WHEN status = 'ACTIVE' THEN 0 ELSE 1 END, person_id NULLS LAST, full_name NULLS LAST, "
    "location_code NULLS LAST, status NULLS LAST, department NULLS LAST, agency NULLS LAST) AS rn "
    "FROM candidates",
    "people": f"SELECT {PERSON_COLUMNS} FROM ranked_people WHERE rn = 1",
    "person_losers": f"SELECT {PERSON_COLUMNS}, 'duplicate_email_lower_precedence' AS "
    "_rejection_reason FROM ranked_people WHERE rn > 1",
}

_GOLD_STEPS = {
    "members": "SELECT m.team_id, t.team_name, t.org_id, t.org_name, "
    "t.primary_office AS team_primary_office, m.employee_email, p.full_name, p.department, "
    "p.agency, m.role, coalesce(p.staff_type, 'UNKNOWN') AS staff_type, p.status AS person_status, "
    "p.location_code AS person_location_code, l.city AS person_city, l.country AS person_country, "
    "l.region AS person_region, m.allocation_pct, m.allocation_was_capped, m.start_date, "
    "m.end_date, m.is_active, p.person_id IS NOT NULL AS person_found, "
    "t.team_id IS NOT NULL AS team_found FROM silver_team_membership m "
    "LEFT JOIN people p ON m.employee_email = p.email "
    "LEFT JOIN silver_teams t ON m.team_id = t.team_id "
    "LEFT JOIN silver_locations l ON p.location_code = l.location_code",
    "place_counts": "SELECT team_id, person_location_code, count(*) AS headcount FROM members "
    "WHERE person_location_code IS NOT NULL GROUP BY team_id, person_location_code",
    "dominant": "SELECT team_id, person_location_code AS dominant_member_location, headcount AS "
    "dominant_location_headcount FROM (SELECT *, row_number() OVER (PARTITION BY team_id ORDER BY "
    "headcount DESC, person_location_code) AS rn FROM place_counts) r WHERE rn = 1",
    "spread": "SELECT team_id, count(*) AS member_count, count(DISTINCT person_location_code) AS "
    "distinct_member_locations, coalesce(string_agg(DISTINCT person_country, ',' ORDER BY "
    "person_country), '') AS member_countries, coalesce(string_agg(DISTINCT person_region, ',' "
    "ORDER BY person_region), '') AS member_regions FROM members GROUP BY team_id",
    "gold_locations": "SELECT t.team_id, t.team_name, t.org_id, t.org_name, t.primary_office, "
    "l.city AS office_city, l.country AS office_country, l.region AS office_region, "
    "l.timezone AS office_timezone, s.member_count, s.distinct_member_locations, "
    "s.member_countries, s.member_regions, d.dominant_member_location, "
    "d.dominant_location_headcount, coalesce(s.distinct_member_locations, 0) > 1 AS "
    "is_distributed, t.primary_office = d.dominant_member_location AS office_matches_members "
    "FROM silver_teams t LEFT JOIN silver_locations l ON t.primary_office = l.location_code "
    "LEFT JOIN spread s ON t.team_id = s.team_id LEFT JOIN dominant d ON t.team_id = d.team_id",
    "gold_achievements": "SELECT a.team_id, coalesce(t.team_name, a.team_name) AS team_name, "
    "t.org_id, t.org_name, a.month_key, count(*) AS achievement_count, "
    "round(round(avg(CASE WHEN impact_source_type = 'NUMERIC' THEN impact_score END), 9), 3) AS "
    "avg_impact_score_numeric, round(round(avg(impact_score), 9), 3) AS avg_impact_score_all, "
    "round(round(sum(impact_score), 9), 2) AS total_impact_score, max(impact_score) AS "
    "max_impact_score, count(DISTINCT category) AS distinct_categories, "
    "coalesce(string_agg(DISTINCT category, ',' ORDER BY category), '') AS categories, "
    "count(*) FILTER (impact_source_type = 'BAND') AS banded_score_count, "
    "count(*) FILTER (team_id_origin = 'RESOLVED_VIA_REPORTER') AS attributed_via_reporter "
    "FROM silver_achievements a LEFT JOIN silver_teams t ON a.team_id = t.team_id "
    "GROUP BY 1, 2, 3, 4, 5",
    "gold_colocation": "SELECT t.team_id, t.team_name, t.team_leader_email, "
    "p.location_code AS leader_location_code, l.city AS leader_city, l.region AS leader_region, "
    "t.primary_office AS team_primary_office, p.person_id IS NOT NULL AS leader_resolved, "
    "d.dominant_member_location, d.dominant_location_headcount, "
    "p.location_code = d.dominant_member_location AS is_colocated_with_members, "
    "p.location_code = t.primary_office AS is_colocated_with_office, "
    "p.location_code <> d.dominant_member_location AS leader_not_colocated "
    "FROM silver_teams t LEFT JOIN people p ON t.team_leader_email = p.email "
    "LEFT JOIN silver_locations l ON p.location_code = l.location_code "
    "LEFT JOIN dominant d ON t.team_id = d.team_id",
    "gold_leaders": "SELECT t.team_id, t.team_name, t.org_id, t.org_name, t.team_leader_email, "
    "p.full_name AS leader_name, p.agency AS leader_agency, p.status AS leader_status, "
    "coalesce(p.staff_type, 'UNRESOLVED') AS leader_staff_type, "
    "p.person_id IS NOT NULL AS leader_resolved, "
    "coalesce(p.staff_type, 'UNRESOLVED') = 'NON_DIRECT' AS leader_is_non_direct "
    "FROM silver_teams t LEFT JOIN people p ON t.team_leader_email = p.email",
    "ratio_counts": "SELECT team_id, team_name, org_id, org_name, count(*) AS member_count, "
    "count(*) FILTER (staff_type = 'DIRECT') AS direct_count, "
    "count(*) FILTER (staff_type = 'NON_DIRECT') AS non_direct_count, "
    "count(*) FILTER (staff_type = 'UNKNOWN') AS unknown_count, "
    "count(*) FILTER (is_active) AS active_member_count FROM members GROUP BY 1, 2, 3, 4",
    "ratio_shares": "SELECT *, direct_count + non_direct_count AS classified_count, "
    "CASE WHEN direct_count + non_direct_count > 0 THEN "
    "round(non_direct_count / (direct_count + non_direct_count), 4) END AS non_direct_ratio, "
    "CASE WHEN direct_count > 0 THEN round(non_direct_count / direct_count, 4) END AS "
    "non_direct_to_direct_ratio FROM ratio_counts",
    "gold_ratios": f"SELECT *, non_direct_ratio > CAST({THRESHOLD} AS DOUBLE) AS "
    f"exceeds_threshold, CAST({THRESHOLD} AS DOUBLE) AS threshold_used FROM ratio_shares",
    "reporting_lines": "SELECT t.org_id, coalesce(o.org_name, t.org_name) AS org_name, "
    "o.org_leader_email, t.reports_to_type, t.reports_to_type = 'Org Leader' AS claims, "
    "t.reporting_manager_email IS NOT NULL AND t.reporting_manager_email = o.org_leader_email AS "
    "verified FROM silver_teams t LEFT JOIN silver_organizations o ON t.org_id = o.org_id",
    "gold_orgs": "SELECT org_id, org_name, org_leader_email, count(*) AS team_count, "
    "CAST(sum(CAST(claims AS INT)) AS BIGINT) AS teams_claiming_org_leader, "
    "CAST(sum(CAST(verified AS INT)) AS BIGINT) AS teams_verified_org_leader, "
    "CAST(sum(CAST(claims AND NOT verified AS INT)) AS BIGINT) AS teams_claim_unverified, "
    "count(DISTINCT reports_to_type) AS distinct_reporting_types, "
    "round(sum(CAST(verified AS INT)) / count(*), 4) AS verified_share "
    "FROM reporting_lines GROUP BY 1, 2, 3",
    "gold_workforce": "SELECT coalesce(p.department, 'UNASSIGNED') AS department, p.staff_type, "
    "p.location_code, l.city, l.country, l.region, count(*) AS headcount, "
    "count(*) FILTER (p.status = 'ACTIVE') AS active_headcount FROM people p "
    "LEFT JOIN silver_locations l ON p.location_code = l.location_code GROUP BY 1, 2, 3, 4, 5, 6",
    "headlines": "SELECT * FROM ("
    "SELECT 'Q1' AS question_id, 'Who are the members of each team?' AS question, "
    "(SELECT count(DISTINCT team_id) FROM members) AS answer, 'teams with a roster' AS unit, "
    "(SELECT count(*) FROM members) || ' membership rows in gold.team_members' AS detail "
    "UNION ALL SELECT 'Q2', 'Where are the teams located?', "
    "(SELECT count(DISTINCT primary_office) FROM gold_locations), 'distinct offices in use', "
    "(SELECT count(*) FROM gold_locations WHERE is_distributed) || "
    "' teams span more than one location' "
    "UNION ALL SELECT 'Q3', 'What are the key achievements of each team monthly?', "
    "(SELECT count(DISTINCT month_key) FROM gold_achievements), 'months covered', "
    "(SELECT count(*) FROM gold_achievements) || "
    "' team-month rows in gold.monthly_team_achievements' "
    "UNION ALL SELECT 'Q4', 'How many teams have a team leader not co-located with team members?', "
    "(SELECT count(*) FROM gold_colocation WHERE leader_not_colocated), 'teams', "
    "'leader location differs from the dominant member location' "
    "UNION ALL SELECT 'Q5', 'How many teams have a team leader who is non-direct staff?', "
    "(SELECT count(*) FROM gold_leaders WHERE leader_is_non_direct), 'teams', "
    "'leader resolves to the vendor roster rather than the directory' "
    "UNION ALL SELECT 'Q6', 'How many teams have a non-direct staff ratio above 20%?', "
    "(SELECT count(*) FROM gold_ratios WHERE exceeds_threshold), 'teams', "
    "'threshold 20%, ratio is non_direct / classified members' "
    "UNION ALL SELECT 'Q7', 'How many teams report to an organisation leader?', "
    "(SELECT CAST(coalesce(sum(teams_verified_org_leader), 0) AS BIGINT) FROM gold_orgs), 'teams', "
    "'verified against organisation reference data; ' || "
    "(SELECT CAST(coalesce(sum(teams_claiming_org_leader), 0) AS BIGINT) FROM gold_orgs) || "
    "' teams claim it in the source') q",
    "run_metrics": "SELECT 'silver' AS layer, team_name || ' ' || coalesce(month_key, '?') AS entity, "
    "count(*) AS rows_read, "
    "count(*) FILTER (reasons <> '') AS rows_quarantined, "
    "count(*) FILTER (reasons = '' AND impact_score IS NOT NULL) AS rows_written, "
    "CASE WHEN count(*) FILTER (reasons = '' AND impact_score IS NOT NULL) = 0 AND count(*) > 1 "
    "THEN 'FAILED' ELSE 'SUCCESS' END AS status, false AS is_aggregate "
    "FROM checked_achievements GROUP BY 2",
}

STEPS: dict[str, str] = {**raw_sql(), **_silver_steps(), **_PEOPLE_STEPS, **_GOLD_STEPS}


def _mentioned(sql: str) -> set[str]:
    return {name for name in re.findall(r"\b[a-z_]+\b", re.sub(r"'[^']*'", "", sql)) if name in STEPS}


def with_steps(sql: str) -> str:
    """Prefix a query with the CTEs it needs, each after those it needs itself."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in sorted(_mentioned(STEPS[name]) - {name}):
            visit(other)
        ordered.append(name)

    for name in sorted(_mentioned(sql)):
        visit(name)
    if not ordered:
        return sql
    # Steps used more than once are computed once.
    parts = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in ordered)
    # A text that begins with a comma brings steps of its own.
    return f"WITH {parts}\n{sql.lstrip()}"
