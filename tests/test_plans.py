from datetime import date

import pytest
from support import rows_of

from lakeconform.plans import gates, insights, marts
from lakeconform.plans.entities import (
    achievement_facts,
    conform_achievements,
    conform_employees,
    conform_locations,
    conform_team_membership,
    conform_teams,
)
from lakeconform.settings import Settings

SETTINGS = Settings(as_of=date(2024, 2, 1))


def texts(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.split()))


def test_settings_reject_a_senseless_threshold():
    with pytest.raises(ValueError):
        Settings(ratio_threshold=1.0)


def test_first_city_wins_a_location_code(spark):
    raw = texts(
        spark,
        "location_code city country region timezone",
        [
            ("LOC-01", "Dallas", "US", "amer", "CST"),
            ("LOC-01", " Austin ", "US", "amer", ""),
            ("LOC-02", "Oslo", "NO", "emea", "CET"),
            ("LOC-03", "Moon", "?", "space", "UTC"),
        ],
    )
    done = conform_locations(raw, SETTINGS)
    assert rows_of(done.kept, "location_code", "city", "region") == [
        ("LOC-01", "Austin", "AMER"),
        ("LOC-02", "Oslo", "EMEA"),
    ]
    assert rows_of(done.rejected, "city", "_rejection_reason") == [
        ("Dallas", "duplicate_business_key[location_code]"),
        ("Moon", "region_known"),
    ]
    totals = done.metrics.first()
    assert (totals.rows_in, totals.rows_valid, totals.timezone_required) == (4, 3, 1)


EMPLOYEE = (
    "emp_id full_name email department location_code employment_type manager_emp_id hire_date status"
)


def employee(emp_id, email="a@acmeinc.com", kind="FT", hired="2020-01-01", status="active"):
    return (emp_id, "N", email, "D", "LOC-01", kind, None, hired, status)


def test_employee_defects(spark):
    raw = texts(
        spark,
        EMPLOYEE,
        [
            employee("EMP-1", status="terminated"),
            employee("EMP-1", status="Active"),
            employee("E2"),
            employee("EMP-3", kind="Seasonal"),
            employee("EMP-4", hired="2024-02-02"),
            employee("EMP-5", hired="soon"),
            employee("EMP-6", email="nobody"),
            employee("EMP-7", status="ended"),
        ],
    )
    done = conform_employees(raw, SETTINGS)
    assert rows_of(done.kept, "emp_id", "status", "hire_date") == [
        ("EMP-1", "ACTIVE", date(2020, 1, 1)),
        ("EMP-5", "ACTIVE", None),
    ]
    assert rows_of(done.rejected, "emp_id", "_rejection_reason") == [
        ("E2", "emp_id_format"),
        ("EMP-1", "duplicate_business_key[emp_id]"),
        ("EMP-3", "employment_type_known"),
        ("EMP-4", "hire_date_not_future"),
        ("EMP-6", "email_required"),
        ("EMP-7", "status_known"),
    ]


def test_teams_unpack_their_organization(spark):
    raw = texts(
        spark,
        "team_id team_name organization team_leader_email primary_office reports_to_type "
        "reporting_manager_email formed_date",
        [
            ("tm7", "Red", '{"org_id":" ORG-1 ","org_name":"O"}', "l@x.com", "LOC-1", "M", None, None),
            ("TEAM-5", "Blue", "{}", "l@x.com", "LOC-1", "M", None, None),
        ],
    )
    done = conform_teams(raw, SETTINGS)
    assert rows_of(done.kept, "team_id", "org_id", "org_name") == [("TM-007", "ORG-1", "O")]
    assert rows_of(done.rejected, "team_name", "_rejection_reason") == [("Blue", "team_id_required")]


def test_membership_is_capped_and_member_beats_lead(spark):
    raw = texts(
        spark,
        "team_code employee_email role allocation_pct start_date end_date",
        [
            ("TM-001", " A@acmeinc.com ", "Team Lead", "150", "August 19, 2023", ""),
            ("tm1", "a@acme-inc.com", "SME", "-3", "2023-08-19", "2024-01-01"),
            ("tm-1", "b@acme-inc.com", "lead", "many", "2023-08-19", "2023-01-01"),
            ("tm-1", "b@acme-inc.com", "boss", "5", "2023-08-20", None),
        ],
    )
    done = conform_team_membership(raw, SETTINGS)
    got = rows_of(
        done.kept, "employee_email", "role", "allocation_pct_raw", "allocation_pct",
        "allocation_was_capped", "is_active",
    )
    assert got == [
        ("a@acme-inc.com", "MEMBER", -3, 0, False, False),
        ("b@acme-inc.com", "TEAM_LEAD", None, None, None, False),
    ]
    assert rows_of(done.rejected, "role", "_rejection_reason") == [
        ("TEAM_LEAD", "duplicate_business_key[team_id,employee_email,start_date]"),
        ("UNKNOWN", "role_known"),
    ]
    totals = done.metrics.first()
    assert totals.allocation_in_range == 2
    assert totals.membership_dates_ordered == 1


ACHIEVEMENT = "team_id team_name month title category impact_score reported_by"


def test_achievements_one_row_per_key_whatever_the_score(spark):
    memberships = texts(spark, "employee_email team_id", [("a@x.com", "TM-001")])
    teams = texts(spark, "team_id team_name", [("TM-001", "Red")])
    rows = [
        ("tm1", "Red", "2024-01", "T", "C", "9.5", "a@x.com"),
        ("TM-001", "Red", "January 2024", "T", "C", "Low", "a@x.com"),
        (None, "Red", "2024/02", "T", "", "junk", "a@x.com"),
        (None, "Blue", "2024/02", "T", "C", "3", "a@x.com"),
        ("tm1", "Red", "2024-03", "T", "C", "11", "a@x.com"),
        ("tm1", "Red", "someday", "T", "C", "1", "a@x.com"),
    ]
    done = conform_achievements(texts(spark, ACHIEVEMENT, rows), memberships, teams, SETTINGS)
    got = rows_of(done.kept, "month_key", "impact_score", "impact_source_type", "team_id_origin")
    assert got == [
        ("2024-01", 2.5, "BAND", "SOURCE"),
        ("2024-02", None, "UNPARSEABLE", "RESOLVED_VIA_REPORTER"),
    ]
    assert sorted(r._rejection_reason for r in done.rejected.collect()) == [
        "duplicate_business_key[achievement_sk]",
        "impact_score_in_range",
        "month_parsed",
        "team_id_resolved",
    ]


def test_achievements_feed_may_lack_team_id(spark):
    raw = texts(spark, ACHIEVEMENT, [(None, "Red", "2024-01", "T", "C", "1", "a@x.com")])
    with_null = achievement_facts(raw, SETTINGS).first()
    without = achievement_facts(raw.drop("team_id"), SETTINGS).first()
    assert without.source_team_id is None
    assert with_null.achievement_sk == without.achievement_sk


@pytest.fixture
def small(spark):
    """Two teams; one leader only among vendors, one unknown; a place with a tie."""
    teams = texts(
        spark,
        "team_id team_name org_id org_name team_leader_email primary_office reports_to_type "
        "reporting_manager_email",
        [
            ("TM-001", "Red", "ORG-1", "One", "v@x.com", "LOC-1", "Org Leader", "boss@x.com"),
            ("TM-002", "Red", "ORG-1", "One", "ghost@x.com", "LOC-2", "Manager", None),
            ("TM-003", "Blue", "ORG-9", "Nine", "d@x.com", None, None, "boss@x.com"),
        ],
    )
    people = texts(
        spark,
        "person_id email full_name location_code status staff_type person_source department agency",
        [
            ("EMP-1", "d@x.com", "D", "LOC-2", "ACTIVE", "DIRECT", "e", "Dep", None),
            ("EMP-2", "e@x.com", "E", "LOC-1", "ACTIVE", "DIRECT", "e", "Dep", None),
            ("CTR-1", "v@x.com", "V", "LOC-2", "ENDED", "NON_DIRECT", "v", None, "Ag"),
        ],
    )
    locations = texts(
        spark,
        "location_code city country region timezone",
        [("LOC-1", "Austin", "US", "AMER", "CST"), ("LOC-2", "Oslo", "NO", "EMEA", "CET")],
    )
    organizations = texts(
        spark, "org_id org_name org_leader_email", [("ORG-1", "First", "boss@x.com")]
    )
    membership = spark.createDataFrame(
        [
            ("TM-001", "d@x.com"),
            ("TM-001", "e@x.com"),
            ("TM-001", "v@x.com"),
            ("TM-001", "e@x.com"),
            ("TM-002", "nobody@x.com"),
            ("TM-999", "d@x.com"),
        ],
        "team_id string, employee_email string",
    ).selectExpr(
        "*",
        "'MEMBER' AS role",
        "50 AS allocation_pct",
        "false AS allocation_was_capped",
        "DATE '2020-01-01' AS start_date",
        "CAST(NULL AS DATE) AS end_date",
        "true AS is_active",
    )
    members = marts.team_members(membership, people, teams, locations)
    return {
        "teams": teams,
        "people": people,
        "locations": locations,
        "organizations": organizations,
        "membership": membership,
        "members": members,
    }


def test_roster_keeps_every_membership(small):
    members = small["members"]
    assert members.count() == small["membership"].count()
    assert tuple(marts.roster_resolution(members).first()) == (1, 1)
    assert rows_of(members.filter("NOT person_found"), "staff_type", "team_name") == [
        ("UNKNOWN", "Red")
    ]


def test_team_locations(small):
    done = marts.team_locations(small["teams"], small["locations"], small["members"])
    got = {r.team_id: r for r in done.collect()}
    red = got["TM-001"]
    assert (red.office_city, red.member_count, red.distinct_member_locations) == ("Austin", 4, 2)
    assert red.member_countries == ["NO", "US"]
    # Two members at each place: the lower code is dominant.
    assert (red.dominant_member_location, red.dominant_location_headcount) == ("LOC-1", 2)
    assert red.is_distributed and red.office_matches_members
    assert got["TM-002"].office_matches_members is None
    assert got["TM-002"].distinct_member_locations == 0
    assert got["TM-003"].member_count is None and got["TM-003"].is_distributed is False


def test_leaders(small):
    done = marts.leader_colocation(
        small["teams"], small["people"], small["locations"], small["members"]
    )
    got = {r.team_id: r for r in done.collect()}
    assert got["TM-001"].leader_not_colocated is True
    assert got["TM-001"].is_colocated_with_office is False
    assert got["TM-002"].leader_not_colocated is None
    assert got["TM-002"].leader_resolved is False
    assert got["TM-003"].is_colocated_with_office is None
    kinds = rows_of(
        marts.leader_staff_type(small["teams"], small["people"]),
        "team_id", "leader_staff_type", "leader_is_non_direct",
    )
    assert kinds == [
        ("TM-001", "NON_DIRECT", True),
        ("TM-002", "UNRESOLVED", False),
        ("TM-003", "DIRECT", False),
    ]


def test_staff_ratio_leaves_out_the_unknown(small):
    got = {r.team_id: r for r in marts.staff_ratio(small["members"], 0.2).collect()}
    assert got["TM-001"].non_direct_ratio == 0.25
    assert got["TM-001"].non_direct_to_direct_ratio == 0.3333
    assert got["TM-001"].exceeds_threshold is True
    assert got["TM-002"].non_direct_ratio is None
    assert got["TM-002"].exceeds_threshold is None


def test_threshold_meets_the_rounded_ratio(spark):
    members = spark.range(50000).selectExpr(
        "'TM-1' AS team_id", "'n' AS team_name", "'o' AS org_id", "'o' AS org_name",
        "IF(id < 10002, 'NON_DIRECT', 'DIRECT') AS staff_type", "true AS is_active",
    )
    row = marts.staff_ratio(members, 0.20).first()
    assert row.non_direct_ratio == 0.2
    assert row.exceeds_threshold is False


def test_reporting_counts_unknown_as_unknown(small):
    got = {r.org_id: r for r in marts.org_reporting(small["teams"], small["organizations"]).collect()}
    one, nine = got["ORG-1"], got["ORG-9"]
    assert (one.org_name, one.team_count, one.teams_claiming_org_leader) == ("First", 2, 1)
    assert (one.teams_verified_org_leader, one.teams_claim_unverified) == (1, 0)
    assert one.verified_share == 0.5
    assert nine.org_name == "Nine"
    assert nine.teams_claiming_org_leader is None
    assert nine.teams_verified_org_leader is None


def test_workforce_summary(small):
    got = rows_of(
        marts.workforce_summary(small["people"], small["locations"]),
        "department", "staff_type", "city", "headcount", "active_headcount",
    )
    assert got == [
        ("Dep", "DIRECT", "Austin", 1, 1),
        ("Dep", "DIRECT", "Oslo", 1, 1),
        ("UNASSIGNED", "NON_DIRECT", "Oslo", 1, 0),
    ]


def test_monthly_achievements(spark, small):
    rows = [
        ("TM-001", "Red", "2024-01", "T", "A", 2.0, "NUMERIC", "SOURCE"),
        ("TM-001", "Red", "2024-01", "U", "B", 8.0, "BAND", "RESOLVED_VIA_REPORTER"),
        ("TM-001", "Rouge", "2024-01", "V", "A", None, "MISSING", "SOURCE"),
        ("TM-999", "Lost", "2024-01", "V", None, None, "MISSING", "SOURCE"),
    ]
    facts = spark.createDataFrame(
        rows,
        "team_id string, team_name string, month_key string, title string, category string, "
        "impact_score double, impact_source_type string, team_id_origin string",
    )
    got = {r.team_id: r for r in marts.monthly_achievements(facts, small["teams"]).collect()}
    red, lost = got["TM-001"], got["TM-999"]
    assert (red.team_name, red.achievement_count, red.categories) == ("Red", 3, ["A", "B"])
    assert (red.avg_impact_score_numeric, red.avg_impact_score_all) == (2.0, 5.0)
    assert (red.total_impact_score, red.max_impact_score) == (10.0, 8.0)
    assert (red.banded_score_count, red.attributed_via_reporter) == (1, 1)
    assert (lost.team_name, lost.org_id, lost.distinct_categories) == ("Lost", None, 0)
    assert lost.total_impact_score is None


METRICS = (
    "layer string, entity string, rows_read long, rows_quarantined long, rows_written long, "
    "status string, is_aggregate boolean"
)


def test_gates(spark):
    rows = [
        ("silver", "good", 10, 2, 8, "SUCCESS", False),
        ("silver", "lossy", 10, 1, 8, "SUCCESS", False),
        ("silver", "dirty", 10, 3, 7, "SUCCESS", False),
        ("silver", "achievements", 10, 3, 7, "SUCCESS", False),
        ("gold", "rollup", 10, 0, 2, "SUCCESS", True),
        ("silver", "empty", 0, 0, 0, "SUCCESS", False),
        ("silver", "broken", 0, 0, 0, "FAILED", False),
    ]
    metrics = spark.createDataFrame(rows, METRICS)
    found = gates.gate_findings(metrics, {"achievements": 0.4})
    assert rows_of(found, "gate", "entity") == [
        ("quarantine", "dirty"),
        ("reconcile", "lossy"),
        ("status", "broken"),
        ("zero_rows", "empty"),
    ]
    assert gates.gate_findings(metrics, {}, 0.5, fail_on_zero_rows=False).count() == 2


def test_histogram_of_a_single_value(spark):
    ratios = spark.createDataFrame(
        [(0.5, True), (0.5, True), (None, None)],
        "non_direct_ratio double, exceeds_threshold boolean",
    )
    assert rows_of(insights.n16_ratio_histogram(ratios)) == [(16, 2, 2, 0)]


def test_answers_that_differ_are_an_error(spark):
    rows = [("Q1", 1, 1, True), ("Q4", 2, 3, False)]
    frame = spark.createDataFrame(rows, "question_id string, recomputed long, stored long, matches boolean")
    with pytest.raises(ValueError, match="Q4"):
        insights.assert_consistent(frame)
    insights.assert_consistent(frame.filter("matches"))
