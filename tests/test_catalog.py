"""Registered queries against their SQL in DuckDB. ``CATALOG=all`` runs every one of them."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lakeconform.catalog import queries as catalog
from lakeconform.plans.contracts import contracts
from lakeconform.settings import Settings

SF_DIR = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"
QUERIES, CHECKS = catalog.queries(), catalog.oracle_sql()
# One query per kind of work; each of them runs the steps of many others.
CHOSEN = (
    "normalize_email",
    "parse_date",
    "parse_month",
    "normalize_code",
    "stringify_nested",
    "latest_snapshot",
    "incremental_load",
    "validate_employees",
    "rejected_team_membership",
    "conform_achievements",
    "dedup_dropped",
    "person_collisions",
    "team_locations",
    "monthly_team_achievements",
    "leader_not_colocated",
    "organization_reporting_summary",
    "employee_summary",
    "n14_ratio_overview",
    "n16_ratio_histogram",
    "quarantine_gate",
    "watermark_delta",
    "refreshed_team_membership",
    "asof_reporter_roles",
    "concurrent_leads",
    "overallocated_spans",
    "event_sessions",
    "reference_failures",
    "adrift_team_membership",
    "weekly_sketches",
    "stream_event_windows",
    "stream_user_sessions",
)

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_check():
    assert QUERIES.keys() == CHECKS.keys()
    assert len(QUERIES) > 100
    assert QUERIES.keys() <= entry.queries().keys()
    assert CHECKS.items() <= entry.oracle_sql().items()


def test_entry(spark):
    df = entry.entry(spark)
    assert "non_direct_ratio" in df.columns
    assert df.count() == 200


@pytest.mark.parametrize("name", QUERIES if os.environ.get("CATALOG") == "all" else CHOSEN)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    expected = duck.execute(CHECKS[name])
    names = [column[0] for column in expected.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    want = sorted(repr(tuple(row[i] for i in places)) for row in expected.fetchall())
    assert sorted(repr(tuple(row)) for row in df.select(*columns).collect()) == want


# Codes are normalised before they are checked, and the surrogate key is never null.
NEVER = {
    ("teams", "team_id_format"),
    ("team_membership", "team_id_format"),
    ("achievements", "team_id_format"),
    ("achievements", "surrogate_key_required"),
}


@pytest.mark.parametrize(("query", "severity"), [("rule_failures", "error"), ("warning_counts", "warning")])
def test_every_rule_has_rows_to_find(spark, query, severity):
    """The derived exports break each rule that can be broken, so no check compares nothing."""
    known = {(c.entity, r.name) for c in contracts(Settings()).values() for r in c.rules if r.severity == severity}
    found = {(r.entity, r.rule) for r in QUERIES[query](spark, SF_LARGER).collect()}
    assert found == known - NEVER
